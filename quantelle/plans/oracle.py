"""SQL definitions of the registered queries, for an independent engine.

Each text is built from common table expressions that restate the input views
and the stages before the operator under test.
"""

from __future__ import annotations

from collections.abc import Mapping

# --------------------------------------------------------------------- views

VIEWS: dict[str, tuple[tuple[str, ...], str]] = {}


def view(name: str, sql: str, *needs: str) -> None:
    VIEWS[name] = (needs, sql)


def with_views(sql: str, *needs: str) -> str:
    """Prefix a statement with the views it needs, dependencies first."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        for parent in VIEWS[name][0]:
            visit(parent)
        if name not in ordered:
            ordered.append(name)

    for name in needs:
        visit(name)
    if not ordered:
        return sql
    return "WITH " + ",\n".join(f"{n} AS ({VIEWS[n][1]})" for n in ordered) + "\n" + sql


PART_ID = "concat('P', {k}, CASE WHEN {k} % 20 = 0 THEN '_UPS' ELSE '' END)"

view("cell", """
  SELECT l_partkey AS k, l_returnflag AS condition, (l_linenumber - 1) % 4 + 1 AS replicate, sum(l_extendedprice) AS a,
         sum(l_extendedprice * l_discount * 10) / sum(l_extendedprice) AS share
  FROM lineitem GROUP BY l_partkey, l_returnflag, (l_linenumber - 1) % 4 + 1""")
view("grid", """
  SELECT i.k, c.condition, r.replicate
  FROM (SELECT DISTINCT k FROM cell) i
  CROSS JOIN (SELECT * FROM (VALUES ('A'), ('N'), ('R')) v(condition)) c
  CROSS JOIN (SELECT * FROM (VALUES (1), (2), (3), (4)) v(replicate)) r""", "cell")
view("quant", f"""
  SELECT {PART_ID.format(k='g.k')} AS id, g.condition, g.replicate,
         coalesce(round(cell.a * CASE WHEN g.k % 20 = 0 AND g.condition = 'N' THEN 16
                                      WHEN g.k % 20 = 0 AND g.condition = 'R' THEN 4 ELSE 1 END, 2), 0.0) AS abundance
  FROM grid g LEFT JOIN cell ON g.k = cell.k AND g.condition = cell.condition AND g.replicate = cell.replicate""",
     "cell", "grid")
view("occupancy", f"""
  SELECT {PART_ID.format(k='g.k')} AS id, g.condition, g.replicate, coalesce(round(cell.share, 6), 0.0) AS abundance
  FROM grid g LEFT JOIN cell ON g.k = cell.k AND g.condition = cell.condition AND g.replicate = cell.replicate""",
     "cell", "grid")


def _clean(source: str, n: int) -> str:
    return f"""
  SELECT * FROM {source} WHERE id IN (
    SELECT id FROM {source} GROUP BY id, condition
    HAVING sum(CASE WHEN abundance <> 0 THEN 1 ELSE 0 END) >= {n})"""


view("cleaned", _clean("quant", 3), "quant")
view("ox_cleaned", _clean("occupancy", 2), "occupancy")
view("logged", """
  SELECT id, condition, replicate, CASE WHEN abundance > 0 THEN log2(abundance) ELSE 0.0 END AS abundance
  FROM cleaned""", "cleaned")
view("within", """
  SELECT id, condition, replicate, CASE WHEN abundance <> 0 THEN abundance ELSE coalesce(mu, 0) END AS abundance
  FROM (SELECT *, avg(CASE WHEN abundance <> 0 THEN abundance END) OVER (PARTITION BY id, condition) AS mu
        FROM logged)""", "logged")
view("imputed", """
  SELECT w.id, w.condition, w.replicate, CASE WHEN w.abundance <> 0 THEN w.abundance ELSE l.level END AS abundance
  FROM within w JOIN (
    SELECT condition, quantile_cont(CASE WHEN abundance <> 0 THEN abundance END, 0.25) AS level
    FROM within GROUP BY condition) l ON w.condition = l.condition""", "within")
view("sample_scaled", """
  SELECT s.id, s.sample, (abundance - mu) / sd AS v
  FROM (SELECT id, concat(condition, '-', replicate) AS sample, abundance FROM logged) s
  JOIN (SELECT concat(condition, '-', replicate) AS sample, avg(abundance) AS mu, stddev_samp(abundance) AS sd
        FROM logged GROUP BY condition, replicate) k ON s.sample = k.sample""", "logged")
view("contrast", "SELECT * FROM (VALUES ('A', 'N'), ('A', 'R'), ('N', 'R')) v(a, b)")


def _moments(source: str) -> str:
    return f"""
  SELECT id, condition, count(abundance) AS n, avg(abundance) AS mean, var_samp(abundance) AS variance
  FROM {source} GROUP BY id, condition"""


def _tests(moments: str) -> str:
    """Two-sided pooled t-test for four against four values (six degrees of freedom)."""
    return f"""
  SELECT id, comparison, fc, t, CASE WHEN t IS NOT NULL THEN
           1 - sin(atan(abs(t) / sqrt(6.0))) * (1 + pow(cos(atan(abs(t) / sqrt(6.0))), 2) / 2
             + 3 * pow(cos(atan(abs(t) / sqrt(6.0))), 4) / 8) END AS p
  FROM (SELECT id, comparison, fc,
               CASE WHEN se >= 2.220446049250313e-15 * greatest(abs(m1), abs(m2)) AND se > 0 THEN fc / se END AS t
        FROM (SELECT x.id, concat(c.a, '-', c.b) AS comparison, x.mean AS m1, y.mean AS m2, y.mean - x.mean AS fc,
                     sqrt((3 * x.variance + 3 * y.variance) / 6 * 0.5) AS se
              FROM contrast c JOIN {moments} x ON x.condition = c.a
              JOIN {moments} y ON y.condition = c.b AND y.id = x.id))"""


def _adjusted(source: str, family: str, p: str = "p", out: str = "q") -> str:
    part = f"PARTITION BY {family}" if family else ""
    return f"""
  SELECT * EXCLUDE (r, m), CASE WHEN {p} IS NOT NULL THEN least(1.0, min({p} * m / r) OVER (
           {part} ORDER BY {p} DESC NULLS LAST RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) END AS {out}
  FROM (SELECT *, count(*) OVER ({part}) AS m,
               count({p}) OVER ({part} ORDER BY {p} NULLS LAST RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS r
        FROM {source})"""


view("log_moments", _moments("logged"), "logged")
view("moments", _moments("imputed"), "imputed")
view("tested", _tests("moments"), "moments", "contrast")
view("adjusted", _adjusted("tested", "comparison"), "tested")
view("ox_moments", _moments("ox_cleaned"), "ox_cleaned")
view("ox_tested", _tests("ox_moments"), "ox_moments", "contrast")
view("variance_terms", """
  SELECT id, sum(n * (mean - grand) * (mean - grand)) / 2 AS msb, sum(3 * variance) / 9 AS msw, max(abs(mean)) AS scale
  FROM (SELECT *, avg(mean) OVER (PARTITION BY id) AS grand FROM moments) GROUP BY id""", "moments")
view("variance_test", """
  SELECT id, f, pow(9 / (9 + 2 * f), 4.5) AS p
  FROM (SELECT id, CASE WHEN sqrt(msw) > 2.220446049250313e-15 * scale THEN msb / msw END AS f
        FROM variance_terms)""", "variance_terms")
view("variance_adjusted", _adjusted("variance_test", ""), "variance_test")
view("profile", """
  SELECT id, condition, CASE condition WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE 2 END AS condition_order,
         (mean - avg(mean) OVER (PARTITION BY id)) / nullif(stddev_samp(mean) OVER (PARTITION BY id), 0) AS z
  FROM moments""", "moments")
view("effect", """
  SELECT x.id, concat(c.a, '-', c.b) AS comparison, y.mean - x.mean AS fc
  FROM contrast c JOIN moments x ON x.condition = c.a JOIN moments y ON y.condition = c.b AND y.id = x.id""",
     "moments", "contrast")

PEP = "translate(upper(replace(p_name, ' ', '')), 'BGL', 'CCS')"

view("peptides", f"""
  SELECT l_orderkey AS feature,
         l_partkey * 10000000 + l_linenumber * 1000000 + l_suppkey AS ordinal,
         CASE WHEN l_tax = 0 THEN '---' ELSE cast(cast(l_quantity AS int) AS varchar) END AS score,
         concat('sp|S', l_suppkey, '|X') AS accession, {PEP} AS sequence,
         CASE WHEN l_linenumber % 4 = 0 THEN NULL
              ELSE concat('[', 1 + l_linenumber % 4, '] Phospho (ST)|[', 1 + l_linenumber % 3,
                          '] Nethylmaleimide (C)|[', 2 + l_linenumber, '] Phospho (ST)') END AS modifications,
         CASE WHEN l_suppkey % 17 = 0 THEN 'cRAP' ELSE 'protein' END AS description,
         l_extendedprice AS s1, l_quantity AS s2, l_discount AS s3
  FROM lineitem JOIN part ON l_partkey = p_partkey""")
view("proteins", """
  SELECT concat('sp|S', s_suppkey, '|X;sp|S', s_suppkey + 1, '|X') AS accession,
         s_nationkey % 6 AS peptide_count,
         CASE WHEN s_suppkey % 13 = 0 THEN NULL ELSE s_nationkey % 4 END AS unique_peptides,
         s_acctbal AS confidence_score,
         CASE WHEN s_suppkey % 17 = 0 THEN 'cRAP' ELSE 'protein' END AS description
  FROM supplier""")
view("members", """
  SELECT unnest(string_split(accession, ';')) AS accession, peptide_count, unique_peptides, confidence_score
  FROM proteins""", "proteins")
view("sequences", f"""
  SELECT concat('sp|S', s_suppkey, '|X') AS accession,
         concat('M', coalesce(string_agg({PEP}, '' ORDER BY p_partkey), '')) AS sequence
  FROM supplier LEFT JOIN part ON p_partkey BETWEEN s_suppkey * 20 AND s_suppkey * 20 + 47 GROUP BY s_suppkey""")
view("scored", """
  SELECT * REPLACE (try_cast(score AS double) AS score) FROM peptides
  WHERE score <> '---' AND try_cast(score AS double) > 13""", "peptides")
view("candidates", """
  SELECT s.*, m.peptide_count, m.unique_peptides, m.confidence_score
  FROM scored s LEFT JOIN members m ON s.accession = m.accession WHERE s.description <> 'cRAP'""",
     "scored", "members")
view("best", """
  SELECT * EXCLUDE (r1, r2) FROM (
    SELECT *, row_number() OVER (PARTITION BY feature ORDER BY score DESC, sequence, modifications NULLS LAST) AS r2
    FROM (SELECT *, row_number() OVER (
            PARTITION BY feature, sequence, modifications, score
            ORDER BY unique_peptides DESC NULLS LAST, confidence_score DESC NULLS LAST, ordinal) AS r1 FROM candidates)
    WHERE r1 = 1 AND unique_peptides IS NOT NULL AND confidence_score IS NOT NULL)
  WHERE r2 = 1""", "candidates")


def _placed(source: str) -> str:
    return f"""
  SELECT p.*, nullif(instr(q.sequence, p.sequence), 0) AS start, row_number() OVER () AS rid
  FROM {source} p LEFT JOIN sequences q ON p.accession = q.accession"""


def _phospho(source: str) -> str:
    return f"""
  SELECT feature, ordinal, CASE WHEN start IS NOT NULL THEN concat(accession, '--', string_agg(
           concat(substr(sequence, pos, 1), start + pos - 1), '-' ORDER BY i)) END AS identifier
  FROM (SELECT *, cast(regexp_extract(m, '\\[([0-9]+)\\]', 1) AS int) AS pos
        FROM (SELECT rid, feature, ordinal, accession, sequence, start,
                     unnest(string_split(modifications, '|')) AS m,
                     generate_subscripts(string_split(modifications, '|'), 1) AS i
              FROM {source} WHERE modifications IS NOT NULL)
        WHERE contains(m, 'Phospho'))
  GROUP BY rid, feature, ordinal, accession, sequence, start"""


def _free_cysteines(source: str) -> str:
    """Positions of C in the peptide that carry no blocking modification."""
    return f"""
  SELECT * FROM (SELECT *, unnest(string_split(sequence, '')) AS residue,
                        generate_subscripts(string_split(sequence, ''), 1) AS pos FROM {source})
  WHERE residue = 'C' AND NOT contains(modifications, concat('[', pos, '] Nethylmaleimide'))"""


def _count(text: str, word: str) -> str:
    return f"((length({text}) - length(replace({text}, '{word}', ''))) / {len(word)})"


def _redox(source: str) -> str:
    return f"""
  SELECT feature, ordinal, CASE WHEN start IS NOT NULL THEN concat(accession, '--', string_agg(
           concat('C', start + pos - 1), '-' ORDER BY pos)) END AS identifier
  FROM ({_free_cysteines(source)}) GROUP BY rid, feature, ordinal, accession, start"""


def _more_cysteines(source: str) -> str:
    return f"""
  SELECT * FROM (SELECT * REPLACE (coalesce(modifications, '') AS modifications) FROM {source})
  WHERE {_count('sequence', 'C')} > {_count('modifications', 'Nethylmaleimide')}"""


view("placed", _placed("peptides"), "peptides", "sequences")
view("phospho", _phospho("placed"), "placed")
view("free", _more_cysteines("peptides"), "peptides")
view("free_placed", _placed("free"), "free", "sequences")
view("best_placed", _placed("best"), "best", "sequences")
view("best_phospho", _phospho("best_placed"), "best_placed")
view("best_free", _more_cysteines("best"), "best")
view("best_free_placed", _placed("best_free"), "best_free", "sequences")
view("best_redox", _redox("best_free_placed"), "best_free_placed")
view("site_ids", """
  SELECT DISTINCT identifier, split_part(identifier, '--', 1) AS accession, split_part(identifier, '--', 2) AS sites
  FROM best_phospho WHERE identifier IS NOT NULL""", "best_phospho")
view("site_counted", """
  SELECT i.identifier, i.accession, i.sites, length(sites) - length(replace(sites, '-', '')) + 1 AS sites_identifier,
         count(*) OVER (PARTITION BY i.accession) AS identifiers_accession, s.n AS sites_accession
  FROM site_ids i JOIN (
    SELECT accession, count(DISTINCT site) AS n
    FROM (SELECT accession, unnest(string_split(sites, '-')) AS site FROM site_ids) GROUP BY accession) s
  ON i.accession = s.accession""", "site_ids")

view("site_peptides", f"""
  SELECT l_orderkey * 10 + l_linenumber AS scan, concat('sp|S', l_suppkey, '|X') AS accession,
         concat(CASE l_linenumber % 3 WHEN 0 THEN 'K.' WHEN 1 THEN 'R.' ELSE '' END,
                substr({PEP}, 1, 3), '(+125.05)', substr({PEP}, 4), '.K') AS peptide,
         concat('C', 1 + l_linenumber % 3, ':N-ethylmaleimide',
                CASE WHEN l_suppkey % 3 = 2 OR (l_suppkey % 3 = 1 AND l_returnflag = 'A') THEN '(D5)' ELSE '' END,
                ':1000.00;M1:Oxidation:12.50') AS ascore,
         CASE WHEN l_linenumber <> 6 THEN l_quantity END AS lgp, l_extendedprice AS s1,
         CASE WHEN l_orderkey % 50 <> 3 THEN l_extendedprice * l_discount END AS s2,
         {PEP} AS bare
  FROM lineitem JOIN part ON l_partkey = p_partkey""")
view("site_rows", """
  SELECT p.scan, p.accession, p.bare AS sequence, split_part(p.ascore, ';', 1) AS ascore, p.lgp, p.s1, p.s2,
         cast(substr(p.ascore, 2, 1) AS int) AS position,
         substr(p.bare, cast(substr(p.ascore, 2, 1) AS int), 1) AS residue,
         CASE WHEN instr(q.sequence, p.bare) > 0 THEN concat(p.accession, '--C',
           instr(q.sequence, p.bare) + cast(substr(p.ascore, 2, 1) AS int) - 1) END AS identifier
  FROM site_peptides p LEFT JOIN sequences q ON p.accession = q.accession""", "site_peptides", "sequences")
view("tagged", """
  SELECT *, concat(identifier, CASE WHEN contains(ascore, 'D5') THEN '-H' ELSE '-L' END) AS label_identifier,
         CASE WHEN contains(ascore, 'D5') THEN 2 ELSE 1 END AS h_or_l,
         replace(ascore, ':1000.00', '') AS modification
  FROM site_rows WHERE identifier IS NOT NULL""", "site_rows")
view("stated", """
  SELECT *, CASE WHEN (mean_modification > 1 AND mean_modification < 2) OR mean_modification > 2 THEN 2 ELSE 1 END
           AS redox_state
  FROM (SELECT *, avg(h_or_l) OVER (PARTITION BY identifier) AS mean_modification FROM tagged)""", "tagged")

view("labelled_candidates", """
  SELECT p.* EXCLUDE (scan), p.scan // 10 AS scan, p.scan * 1000000 + cast(floor(p.s1) AS bigint) AS ordinal,
         CASE WHEN p.scan % 2 = 0 THEN 'N-ethylmaleimide' END AS ptm,
         CASE WHEN s_suppkey % 13 <> 0 THEN s_nationkey % 4 END AS unique_peptides,
         CASE WHEN s_suppkey % 19 <> 0 THEN s_acctbal END AS lgp_protein
  FROM site_peptides p JOIN supplier ON p.accession = concat('sp|S', s_suppkey, '|X')
  WHERE s_suppkey % 17 <> 0""", "site_peptides")
view("labelled_best", """
  SELECT * EXCLUDE (r1, r2) FROM (
    SELECT *, row_number() OVER (PARTITION BY scan ORDER BY lgp DESC NULLS LAST, peptide, ptm NULLS LAST) AS r2
    FROM (SELECT *, row_number() OVER (
            PARTITION BY scan, peptide, ptm, lgp
            ORDER BY unique_peptides DESC NULLS LAST, lgp_protein DESC NULLS LAST, ordinal) AS r1 FROM labelled_candidates)
    WHERE r1 = 1 AND unique_peptides IS NOT NULL AND lgp_protein IS NOT NULL)
  WHERE r2 = 1""", "labelled_candidates")
view("best_site_rows", VIEWS["site_rows"][1].replace("site_peptides", "labelled_best"), "labelled_best", "sequences")
view("best_tagged", VIEWS["tagged"][1].replace("site_rows", "best_site_rows"), "best_site_rows")
view("best_stated", VIEWS["stated"][1].replace("tagged", "best_tagged"), "best_tagged")

view("annotation", """
  SELECT concat('S', s_suppkey) AS entry,
         CASE WHEN s_suppkey % 11 = 0 THEN NULL
              ELSE concat('process ', s_nationkey % 5, ' [GO:000000', s_nationkey % 5, ']; process ', 5 + s_suppkey % 4,
                          ' [GO:000000', 5 + s_suppkey % 4, ']') END AS go_bp,
         concat('a deliberately long molecular function name for truncation ', s_nationkey % 3,
                ' [GO:0000010]') AS go_mf,
         CASE s_suppkey % 3 WHEN 0 THEN 'A' WHEN 1 THEN 'B' ELSE 'C' END AS cluster
  FROM supplier""")
view("terms", """
  SELECT accession, cluster, category, CASE WHEN length(term) > 50 THEN concat(substr(term, 1, 47), '...')
                                            ELSE term END AS term
  FROM (SELECT accession, cluster, category, substr(term, 1, length(term) - 13) AS term
        FROM (SELECT entry AS accession, cluster, 'biological process' AS category,
                     unnest(string_split(go_bp, '; ')) AS term FROM annotation WHERE go_bp IS NOT NULL
              UNION ALL
              SELECT entry, cluster, 'molecular function', unnest(string_split(go_mf, '; ')) FROM annotation))""",
     "annotation")
view("part_terms", f"""
  SELECT id, unnest(['process ' || (k % 7), 'process ' || (7 + k % 11)]) AS term
  FROM (SELECT {PART_ID.format(k='p_partkey')} AS id, p_partkey AS k FROM part WHERE p_partkey % 9 <> 0
        UNION ALL SELECT concat('X', s_suppkey), s_suppkey FROM supplier WHERE s_suppkey % 9 <> 0)""")


def _frequent_terms(values: str, columns: str, threshold: int) -> str:
    return f"""
SELECT v.id, {columns}, t.term, c.n, concat(t.term, chr(10), c.n) AS term_n
FROM {values} v JOIN part_terms t ON v.id = t.id
JOIN (SELECT term, count(DISTINCT id) AS n FROM part_terms WHERE id IN (SELECT id FROM {values})
      GROUP BY term HAVING count(DISTINCT id) > {threshold}) c
  ON t.term = c.term"""


def _wide(value: str, digits: int | None = None) -> str:
    fmt = "round({}, %d)" % digits if digits is not None else "{}"
    return ", ".join(
        fmt.format(f"max(CASE WHEN condition = '{c}' AND replicate = {r} THEN {value} END)") + f' AS "{c}-{r}"'
        for c in "ANR" for r in range(1, 5))


SAMPLES = [f"{c}-{r}" for c in "ANR" for r in range(1, 5)]


def _reduced(source: str, key: str, extra: str = "", score: str = "score", ordinal: str = "ordinal, feature",
             samples: tuple[str, ...] = ("s1", "s2", "s3"), digits: int = 2) -> str:
    """Attributes of the best row and summed samples per key."""
    sums = ", ".join(f"CASE WHEN count({s}) = count(*) THEN round(sum({s}), {digits}) END AS {s}" for s in samples)
    attributes = "".join(f", b.{c}" for c in extra.split())
    return f"""
SELECT a.{key}{attributes}, {', '.join('a.' + s for s in samples)}
FROM (SELECT {key}, {sums} FROM {source} GROUP BY {key} HAVING count({score}) > 0) a
JOIN (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY {score} DESC NULLS LAST, {ordinal}) AS rn FROM {source}) b
  ON a.{key} = b.{key} AND b.rn = 1"""


def _identified(source: str, ids: str) -> str:
    return f"""(SELECT p.*, i.identifier FROM {source} p JOIN {ids} i
  ON p.feature = i.feature AND p.ordinal = i.ordinal WHERE i.identifier IS NOT NULL)"""


ORACLE_SQL: dict[str, str] = {}


def check(name: str, sql: str, *needs: str) -> None:
    ORACLE_SQL[name] = with_views(sql, *needs)


# ------------------------------------------------------- reshape and cleaning

LONG = "SELECT id, condition, replicate, {} AS abundance FROM {}"
check("densify", LONG.format("abundance", "quant"), "quant")
check("to_long", LONG.format("abundance", "quant"), "quant")
check("to_wide", f"SELECT id, {_wide('abundance')} FROM quant GROUP BY id", "quant")
check("rename_columns", f"SELECT id, {_wide('abundance')} FROM quant GROUP BY id", "quant")
check("clean_min", LONG.format("abundance", "cleaned"), "cleaned")
check("log2_transform", LONG.format("round(CASE WHEN abundance > 0 THEN log2(abundance) ELSE 0 END, 6)", "quant"), "quant")
check("asinh_transform", LONG.format("round(asinh(abundance), 6)", "quant"), "quant")
check("back_transform", LONG.format("round(pow(2, asinh(abundance)), 4)", "quant"), "quant")
check("impute_center", LONG.format("round(abundance, 6)", "imputed"), "imputed")


def _normal(seed: int) -> str:
    """Box-Muller on two runs of twelve digits of an MD5."""
    text = f"md5(concat_ws('|', '{seed}', id, condition, replicate))"
    u = [f"((('0x' || substr({text}, {at}, 12))::BIGINT + 0.5) / 281474976710656.0::double)" for at in (1, 13)]
    return f"(sqrt(-2.0::double * ln({u[0]})) * cos(6.283185307179586::double * {u[1]}))"


def _spread(source: str) -> str:
    return f"""(SELECT condition, quantile_cont(s, 0.5) AS sd FROM (
      SELECT id, condition, stddev_samp(CASE WHEN abundance <> 0 THEN abundance END) AS s FROM {source} GROUP BY id, condition)
    WHERE s IS NOT NULL GROUP BY condition)"""


view("within_draw", f"""
  SELECT id, m.condition, replicate, CASE WHEN abundance <> 0 THEN abundance
         ELSE coalesce(mu + coalesce(sd, 0.0) * {_normal(123).replace('condition', 'm.condition')}, 0.0) END AS abundance
  FROM (SELECT *, avg(CASE WHEN abundance <> 0 THEN abundance END) OVER (PARTITION BY id, condition) AS mu FROM logged) m
  LEFT JOIN {_spread('logged')} s ON s.condition = m.condition""", "logged")
check("impute_draw", f"""
SELECT id, w.condition, replicate, round(CASE WHEN abundance <> 0 THEN abundance
         ELSE level + coalesce(sd, 0.0) * {_normal(124).replace('condition', 'w.condition')} END, 6) AS abundance
FROM within_draw w JOIN (
  SELECT condition, quantile_cont(CASE WHEN abundance <> 0 THEN abundance END, 0.25) AS level FROM within_draw GROUP BY condition) l
  ON w.condition = l.condition LEFT JOIN {_spread('within_draw')} s ON s.condition = w.condition""", "within_draw")
check("missingness", """
SELECT c.id, nullif(string_agg(CASE WHEN total = 0 THEN condition END, '-' ORDER BY condition), '') AS missing
FROM (SELECT DISTINCT id FROM cleaned) c
JOIN (SELECT id, condition, sum(abundance) AS total FROM quant GROUP BY id, condition) s ON c.id = s.id
GROUP BY c.id""", "cleaned", "quant")
check("keep_tested", f"SELECT id, condition, replicate, abundance FROM ({_clean('quant', 4)})", "quant")

# ------------------------------------------------------------------ statistics

check("group_moments",
      "SELECT id, condition, n, round(mean, 6) AS mean, round(variance, 6) AS variance FROM log_moments", "log_moments")
check("condition_means", "SELECT id, condition, round(mean, 6) AS mean FROM log_moments", "log_moments")
LOG_EFFECT = """
  SELECT x.id, concat(c.a, '-', c.b) AS comparison, y.mean - x.mean AS fc
  FROM contrast c JOIN log_moments x ON x.condition = c.a JOIN log_moments y ON y.condition = c.b AND y.id = x.id"""
check("fold_change", f"SELECT id, comparison, round(fc, 6) AS fc FROM ({LOG_EFFECT})", "log_moments", "contrast")
EXTREME = "CASE WHEN max({0}) > abs(min({0})) THEN max({0}) ELSE min({0}) END"
check("fc_max", f"SELECT id, round({EXTREME.format('fc')}, 6) AS fc_max FROM ({LOG_EFFECT}) GROUP BY id",
      "log_moments", "contrast")
check("f_tail", """
SELECT l_orderkey, l_linenumber, l_partkey, l_quantity / 5 AS f,
       round(pow(9 / (9 + 2 * (l_quantity / 5)), 4.5), 9) AS p FROM lineitem""")
check("ttest", """
SELECT id, comparison, round(fc, 6) AS fc, round(t, 6) AS t, round(p, 6) AS p_value, round(q, 6) AS fdr
FROM adjusted""", "adjusted")
check("anova", "SELECT id, round(f, 5) AS f, round(p, 5) AS p_value, round(q, 5) AS fdr FROM variance_adjusted",
      "variance_adjusted")
PIVOT_TESTS = ", ".join(
    f"""round(max(CASE WHEN comparison = '{c}' THEN {col} END), {{0}}) AS "{c}_{suffix}\""""
    for c in ("A-N", "A-R", "N-R") for col, suffix in (("p", "P"), ("fc", "FC")))
check("results_join", f"""
SELECT m.*, t.* EXCLUDE (id) FROM (
  SELECT id, {', '.join(f"round(max(CASE WHEN condition = '{c}' THEN mean END), 6) AS {chr(34)}{c}_mean{chr(34)}"
                        for c in 'ANR')} FROM moments GROUP BY id) m
LEFT JOIN (SELECT id, {PIVOT_TESTS.format(6)} FROM tested GROUP BY id) t ON m.id = t.id""", "moments", "tested")
TEST_ROWS = """(SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag,
    CASE WHEN l_tax <> 0 THEN cast(floor(l_extendedprice) AS bigint) % 5000 / 5000.0::double END AS p FROM lineitem)"""
check("bh_adjust", f"""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag, p, round(q, 9) AS q
FROM ({_adjusted(TEST_ROWS, 'l_returnflag')})""")
check("exact_quantiles", """
SELECT l_returnflag, l_linenumber, round(quantile_cont(l_extendedprice, 0.05), 4) AS q05,
       round(quantile_cont(l_extendedprice, 0.25), 4) AS q25, round(quantile_cont(l_extendedprice, 0.5), 4) AS median,
       round(quantile_cont(l_extendedprice, 0.9), 4) AS q90
FROM lineitem GROUP BY l_returnflag, l_linenumber""")
check("zscore_profiles", "SELECT id, condition, condition_order, round(z, 6) AS z FROM profile", "profile")
PAIRS = """
  FROM (SELECT id, concat(condition, '-', replicate) AS sample, abundance FROM logged) x
  JOIN (SELECT id, concat(condition, '-', replicate) AS sample, abundance FROM logged) y ON x.id = y.id
  GROUP BY x.sample, y.sample"""
check("sample_correlation", f"""
SELECT x.sample AS sample1, y.sample AS sample2, round(corr(x.abundance, y.abundance), 6) AS r {PAIRS}""", "logged")
check("sample_distance", """
SELECT x.sample AS sample1, y.sample AS sample2, round(sqrt(sum((x.v - y.v) * (x.v - y.v))), 5) AS distance
FROM sample_scaled x JOIN sample_scaled y ON x.id = y.id GROUP BY x.sample, y.sample""", "sample_scaled")

SAMPLE_LIST = "[" + ", ".join(f"'{x}'" for x in SAMPLES) + "]"
view("sample_covariance", f"""
  SELECT list(row ORDER BY i) AS m FROM (
    SELECT i, list(c ORDER BY j) AS row FROM (
      SELECT list_position({SAMPLE_LIST}, x.sample) AS i, list_position({SAMPLE_LIST}, y.sample) AS j, covar_samp(x.abundance, y.abundance) AS c {PAIRS})
    GROUP BY i)""", "logged")


def _leading(name: str, source: str, steps: int = 45) -> None:
    """The leading eigenvector of a symmetric matrix: it is squared and scaled again and
    again, then the column of largest norm is taken."""
    last = source
    for step in range(steps // 5):
        expression = "m"
        for _ in range(5):
            trace = f"list_sum(list_transform(range(1, {len(SAMPLES) + 1}), lambda i: m[i][i]))"
            expression = f"(SELECT list_transform(m, lambda r: list_transform(m, lambda c: list_dot_product(r, c) / ({trace} * {trace}))) AS m FROM {expression})" if expression != "m" else f"(SELECT list_transform(m, lambda r: list_transform(m, lambda c: list_dot_product(r, c) / ({trace} * {trace}))) AS m FROM {last})"
        view(f"{name}{step}", f"SELECT m FROM {expression}", last)
        last = f"{name}{step}"
    view(name, f"""
  SELECT list_transform(v, lambda x: x * s) AS v FROM (
    SELECT v, CASE WHEN list_max(v) < -list_min(v) THEN -1.0 ELSE 1.0 END / sqrt(list_dot_product(v, v)) AS s FROM (
      SELECT m[list_position(list_transform(range(1, {len(SAMPLES) + 1}), lambda i: m[i][i]),
               list_max(list_transform(range(1, {len(SAMPLES) + 1}), lambda i: m[i][i])))] AS v FROM {last}))""", last)


_leading("component1_", "sample_covariance")
view("sample_rest", f"""
  SELECT list_transform(range(1, {len(SAMPLES) + 1}), lambda i: list_transform(range(1, {len(SAMPLES) + 1}), lambda j: m[i][j] - l * v[i] * v[j])) AS m
  FROM (SELECT m, v, list_dot_product(list_transform(m, lambda r: list_dot_product(r, v)), v) AS l FROM sample_covariance, component1_)""",
     "sample_covariance", "component1_")
_leading("component2_", "sample_rest")
check("pca_loadings", f"""
SELECT left(s, 1) AS condition, cast(right(s, 1) AS int) AS replicate, CASE left(s, 1) WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE 2 END AS condition_order,
       round(pc1, 6) AS pc1, round(pc2, 6) AS pc2
FROM (SELECT unnest({SAMPLE_LIST}) AS s, unnest(component1_.v) AS pc1, unnest(component2_.v) AS pc2 FROM component1_, component2_)""", "component1_", "component2_")

ZS = ", ".join(f"""max(CASE WHEN condition = '{c}' THEN z END) AS "{c}_Z\"""" for c in "ANR")
QS = ", ".join(f"""cast(round("{c}_Z" * 1000000) AS BIGINT) AS q{i}""" for i, c in enumerate("ANR"))
view("points0", f"""
  SELECT *, 0 AS g, {QS} FROM (SELECT id, {ZS} FROM profile GROUP BY id)
  WHERE "A_Z" IS NOT NULL AND "N_Z" IS NOT NULL AND "R_Z" IS NOT NULL""", "profile")


def _distance(centre: str) -> str:
    d = [f"(cast(q{i} AS DOUBLE) - {centre}{i})" for i in range(3)]
    return f"({d[0]} * {d[0]} + {d[1]} * {d[1]} + {d[2]} * {d[2]})"


def _bisected(new: int, rounds: int = 8, of: str = "") -> None:
    """``points<new>``: the largest cluster of the points before, split; ``of`` prefixes all names."""
    before = f"{of}points{new - 1}"
    view(f"{of}member{new}", f"SELECT * FROM {before} WHERE g = (SELECT g FROM {before} GROUP BY g ORDER BY count(*) DESC, g LIMIT 1)", before)
    view(f"{of}middle{new}", "SELECT " + ", ".join(f"cast(sum(q{i}) AS DOUBLE) / count(*) AS m{i}" for i in range(3)) + f" FROM {of}member{new}", f"{of}member{new}")
    view(f"{of}first{new}", f"SELECT {', '.join(f'cast(q{i} AS DOUBLE) AS a{i}' for i in range(3))} FROM {of}member{new}, {of}middle{new} ORDER BY {_distance('m')} DESC, id LIMIT 1",
         f"{of}member{new}", f"{of}middle{new}")
    view(f"{of}centres{new}_0", f"SELECT a0, a1, a2, {', '.join(f'cast(q{i} AS DOUBLE) AS b{i}' for i in range(3))} FROM {of}member{new}, {of}first{new} ORDER BY {_distance('a')} DESC, id LIMIT 1",
         f"{of}member{new}", f"{of}first{new}")
    for r in range(1, rounds + 1):
        means = ", ".join(f"coalesce(cast(sum(q{i}) FILTER (WHERE {'' if side == 'b' else 'NOT '}second) AS DOUBLE) / nullif(count(*) FILTER (WHERE {'' if side == 'b' else 'NOT '}second), 0), any_value({side}{i})) AS {side}{i}"
                          for side in "ab" for i in range(3))
        view(f"{of}centres{new}_{r}", f"SELECT {means} FROM (SELECT *, {_distance('b')} < {_distance('a')} AS second FROM {of}member{new}, {of}centres{new}_{r - 1})",
             f"{of}member{new}", f"{of}centres{new}_{r - 1}")
    view(f"{of}points{new}", f"""
  SELECT id, "A_Z", "N_Z", "R_Z", q0, q1, q2,
         CASE WHEN id IN (SELECT id FROM {of}member{new}, {of}centres{new}_{rounds} WHERE {_distance('b')} < {_distance('a')}) THEN {new} ELSE g END AS g
  FROM {before}""", before, f"{of}member{new}", f"{of}centres{new}_{rounds}")


_bisected(1)
_bisected(2)
LETTERED = """
  SELECT id, "A_Z", "N_Z", "R_Z", chr(CAST(64 + o AS INT)) AS cluster FROM points2 p
  JOIN (SELECT g, row_number() OVER (ORDER BY min(id)) AS o FROM points2 GROUP BY g) l ON p.g = l.g"""
view("clustered", LETTERED, "points2")
view("differing_points0", "SELECT * FROM points0 WHERE id IN (SELECT id FROM variance_adjusted WHERE q < 0.05)", "points0", "variance_adjusted")
_bisected(1, of="differing_")
_bisected(2, of="differing_")
view("differing_clustered", LETTERED.replace("points2", "differing_points2"), "differing_points2")
check("cluster_profiles", """SELECT id, round("A_Z", 6) AS "A_Z", round("N_Z", 6) AS "N_Z", round("R_Z", 6) AS "R_Z", cluster FROM clustered""", "clustered")
check("clustered_analysis", """SELECT id, round("A_Z", 6) AS "A_Z", round("N_Z", 6) AS "N_Z", round("R_Z", 6) AS "R_Z", cluster
FROM differing_clustered""", "differing_clustered")
check("cluster_profile_long", """
SELECT id, cluster, cluster || chr(10) || count(*) OVER (PARTITION BY cluster, condition) AS cluster_count, condition, condition_order, round(z, 6) AS z
FROM (SELECT id, cluster, unnest(['A', 'N', 'R']) AS condition, unnest([0, 1, 2]) AS condition_order, unnest(["A_Z", "N_Z", "R_Z"]) AS z FROM clustered)""", "clustered")

# ------------------------------------------------------------ result summaries

check("results_long", "SELECT id, comparison, round(p, 6) AS \"P\", round(fc, 6) AS \"FC\" FROM tested", "tested")
check("volcano_classify", """
SELECT id, comparison, round(fc, 6) AS fc, round(q, 6) AS significance,
       cast(fc <= -1 AND q < 0.05 AS int) AS down, cast(fc >= 1 AND q < 0.05 AS int) AS up,
       CASE WHEN fc <= -1 AND q < 0.05 THEN 'down' WHEN (fc <= -1 AND q < 0.05) IS NULL THEN NULL
            WHEN fc >= 1 AND q < 0.05 THEN 'up' WHEN (fc >= 1 AND q < 0.05) IS NULL THEN NULL ELSE 'same' END AS type
FROM adjusted""", "adjusted")


def _counts(source: str, effect: str, cut: str) -> str:
    return f"""
  SELECT comparison, cast(sum(CASE WHEN {effect} <= -{cut} AND p < 0.05 THEN 1 ELSE 0 END) AS bigint) AS down,
         cast(sum(CASE WHEN {effect} >= {cut} AND p < 0.05 THEN 1 ELSE 0 END) AS bigint) AS up, count(*) AS n
  FROM {source} GROUP BY comparison"""


LABEL = "concat(comparison, chr(10), 'Down ', down, ' / Up ', up)"
check("volcano_counts", f"SELECT *, {LABEL} AS label FROM ({_counts('tested', 'fc', '1')})", "tested")
TYPE = """CASE WHEN {0} <= -{1} AND p < 0.05 THEN 'down' WHEN ({0} <= -{1} AND p < 0.05) IS NULL THEN NULL
            WHEN {0} >= {1} AND p < 0.05 THEN 'up' WHEN ({0} >= {1} AND p < 0.05) IS NULL THEN NULL
            ELSE 'same' END"""
check("volcano_change_ox", f"""
SELECT t.id, t.comparison, round(fc, 9) AS change_ox, round(p, 9) AS significance, {TYPE.format('fc', '0.1')} AS type, label
FROM ox_tested t JOIN (SELECT comparison, {LABEL} AS label FROM ({_counts('ox_tested', 'fc', '0.1')})) l
  ON t.comparison = l.comparison""", "ox_tested")
check("volcano_by_label", f"""
SELECT t.id, CASE WHEN ends_with(t.id, '_UPS') THEN 'Oxidized' ELSE 'Reduced' END AS red_or_ox, t.comparison,
       round(fc, 6) AS fc, {TYPE.format('fc', '1')} AS type, label
FROM tested t JOIN (SELECT comparison, {LABEL} AS label FROM ({_counts('tested', 'fc', '1')})) l
  ON t.comparison = l.comparison""", "tested")
CLASS = "CASE WHEN contains(id, '_UPS') THEN 'UPS1' ELSE 'Background' END"
check("summarize_volcano", f"""
SELECT id, comparison, round(fc, 6) AS fc, round(q, 6) AS fdr, {CLASS} AS class FROM adjusted""", "adjusted")
check("fdr_by_class", f"""
SELECT comparison, nullif(sum(CASE WHEN class = 'Background' THEN 1 ELSE 0 END), 0)::bigint AS "Background",
       nullif(sum(CASE WHEN class = 'UPS1' THEN 1 ELSE 0 END), 0)::bigint AS "UPS1"
FROM (SELECT comparison, {CLASS} AS class FROM adjusted WHERE q < 0.05) GROUP BY comparison""", "adjusted")
check("fc_summary", f"""
SELECT comparison, class, round(median(x), 5) AS median, round(avg(x), 5) AS mean, round(stddev_samp(x), 5) AS sd
FROM (SELECT comparison, {CLASS} AS class, pow(2, fc) AS x FROM effect) GROUP BY comparison, class""", "effect")
check("cv_summary", """
SELECT condition, round(avg(cv), 6) AS cv_mean, round(quantile_cont(cv, 0.5), 6) AS cv_median,
       round(quantile_cont(cv, 0.9), 6) AS cv_90
FROM (SELECT condition, sqrt(variance) / nullif(mean, 0) * 100 AS cv FROM moments) GROUP BY condition""", "moments")
check("cv_by_class", """
SELECT condition, class, round(median(cv), 6) AS median
FROM (SELECT condition, CASE WHEN contains(id, '_UPS') THEN 'P' ELSE 'N' END AS class,
             stddev_samp(pow(2, abundance)) / avg(pow(2, abundance)) * 100 AS cv
      FROM imputed GROUP BY id, condition) GROUP BY condition, class""", "imputed")
check("z_by_class", f"""
SELECT id, condition, condition_order, round(z, 6) AS z, {CLASS} AS class FROM profile""", "profile")
COUNTED = """(SELECT modifications, count(*) AS n FROM peptides WHERE modifications IS NOT NULL GROUP BY modifications)"""
check("value_counts", f"SELECT modifications, n, round(n / (SELECT sum(n) FROM {COUNTED}), 9) AS freq FROM {COUNTED}",
      "peptides")
check("term_counts", f"""
SELECT modifications, n, round(n / (SELECT sum(n) FROM {COUNTED}), 9) AS freq,
       CASE WHEN length(modifications) > 25 THEN concat(substr(modifications, 1, 22), '...') ELSE modifications END AS term
FROM {COUNTED} WHERE n > 50""", "peptides")
check("site_counts", "SELECT * FROM site_counted", "site_counted")
check("sites_per_accession", """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY accession ORDER BY identifier) AS rn FROM site_counted) WHERE rn = 1""",
      "site_counted")
check("box_stats", """
SELECT i.condition, i.replicate, round(q1, 6) AS q1, round(med, 6) AS median, round(q3, 6) AS q3,
       round(min(CASE WHEN inside THEN abundance END), 6) AS lower,
       round(max(CASE WHEN inside THEN abundance END), 6) AS upper, count(*) AS n,
       cast(sum(CASE WHEN inside THEN 0 ELSE 1 END) AS bigint) AS outliers
FROM (SELECT x.*, q1, med, q3,
             abundance >= q1 - 1.5 * (q3 - q1) AND abundance <= q3 + 1.5 * (q3 - q1) AS inside
      FROM imputed x JOIN (
        SELECT condition, replicate, quantile_cont(abundance, 0.25) AS q1, quantile_cont(abundance, 0.5) AS med,
               quantile_cont(abundance, 0.75) AS q3 FROM imputed GROUP BY condition, replicate) q
      ON x.condition = q.condition AND x.replicate = q.replicate) i
GROUP BY i.condition, i.replicate, q1, med, q3""", "imputed")
check("histogram", """
SELECT condition, bin, count(*) AS n, round(bin * 0.1::double, 6) AS center
FROM (SELECT condition, cast(floor((round(mean, 9) + 0.05::double) / 0.1::double) AS bigint) AS bin FROM ox_moments)
GROUP BY condition, bin""", "ox_moments")
check("heatmap_order", "SELECT id, round(avg(abundance), 6) AS mean_value FROM logged GROUP BY id", "logged")

# ------------------------------------------------ identifications, identifiers

check("accession_group_split", """
SELECT split_part(accession, ';', 1) AS accession, peptide_count, unique_peptides, confidence_score, description,
       CASE WHEN contains(accession, ';') THEN substr(accession, instr(accession, ';') + 1) END AS group_members
FROM proteins""", "proteins")
check("explode_accessions", "SELECT * FROM members", "members")
check("drop_contaminants", "SELECT * FROM proteins WHERE description <> 'cRAP'", "proteins")
check("peptide_evidence", "SELECT * FROM proteins WHERE peptide_count >= 2 AND unique_peptides >= 1", "proteins")
check("filter_score", "SELECT feature, ordinal, score, accession FROM scored", "scored")
check("filter_modified",
      "SELECT feature, ordinal, modifications FROM peptides WHERE contains(modifications, 'Phospho')", "peptides")
check("filter_redox", "SELECT feature, ordinal, sequence, modifications FROM free", "free")
check("select_abundance", "SELECT feature, s1, s2, s3 FROM peptides", "peptides")
check("peptide_identifier",
      "SELECT feature, ordinal, accession || '--' || sequence AS identifier FROM peptides", "peptides")
check("attach_protein_stats", """
SELECT feature, ordinal, accession, peptide_count, unique_peptides, confidence_score FROM candidates""", "candidates")
check("attach_proteins_inner", """
SELECT p.feature, p.ordinal, p.accession, p.description, q.description AS description_protein, q.unique_peptides
FROM peptides p JOIN proteins q ON p.accession = split_part(q.accession, ';', 1) WHERE q.description <> 'cRAP'""",
      "peptides", "proteins")
check("reduce_features", """
SELECT feature, ordinal, sequence, modifications, score, accession, unique_peptides, confidence_score FROM best""", "best")
PEPTIDE_IDS = "(SELECT *, accession || '--' || sequence AS identifier FROM scored)"
check("reduce_identifiers", _reduced(PEPTIDE_IDS, "identifier",
                                     "feature ordinal score accession sequence modifications description"), "scored")
check("first_per_key", """
SELECT accession, sequence, ordinal, feature FROM (
  SELECT *, row_number() OVER (PARTITION BY accession ORDER BY ordinal, feature, sequence) AS rn FROM peptides)
WHERE rn = 1""", "peptides")
check("top_k_per_group", """
SELECT accession, sequence, n FROM (
  SELECT *, row_number() OVER (PARTITION BY accession ORDER BY n DESC, sequence) AS rn
  FROM (SELECT accession, sequence, count(*) AS n FROM peptides GROUP BY accession, sequence)) WHERE rn <= 3""", "peptides")
check("attach_sequence", "SELECT feature, ordinal, accession, sequence, start FROM placed", "placed")
check("phospho_sites", """
SELECT feature, ordinal, identifier FROM phospho""", "phospho")
check("redox_sites", _redox("free_placed"), "free_placed")
check("cys_sites", """
SELECT feature, ordinal, pos AS cys, coalesce(contains(modifications, concat('[', pos, '] Nethylmaleimide')), false) AS blocked
FROM (SELECT *, unnest(string_split(sequence, '')) AS residue,
             generate_subscripts(string_split(sequence, ''), 1) AS pos FROM peptides)
WHERE residue = 'C'""", "peptides")

# ------------------------------------------------------------- labelled sites

check("strip_peptide", "SELECT scan, accession, peptide, bare AS sequence FROM site_peptides", "site_peptides")
check("site_scores", "SELECT scan, accession, ascore, position, residue FROM site_rows", "site_rows")
check("locate_site", "SELECT scan, accession, sequence, identifier FROM site_rows", "site_rows")
check("label_state", "SELECT scan, label_identifier, h_or_l, modification FROM tagged", "tagged")
check("redox_state", """
SELECT scan, identifier, h_or_l, round(mean_modification, 6) AS mean_modification, redox_state FROM stated""", "stated")
check("split_reduced_oxidized", """
SELECT scan, label_identifier, CASE WHEN h_or_l = 1 THEN 'Reduced' ELSE 'Oxidized' END AS red_or_ox
FROM stated WHERE redox_state = 1""", "stated")
LABEL_ROWS = "(SELECT *, scan * 1000000 + cast(floor(s1) AS bigint) AS ordinal FROM stated)"
check("reduce_label_identifiers", _reduced(LABEL_ROWS, "label_identifier", "scan lgp redox_state", "lgp", "ordinal",
                                           ("s1", "s2"), 5), "stated")
check("percent_oxidized", f"""
SELECT concat(identifier, '-H') AS identifier,
       {', '.join(f"round(coalesce(sum(CASE WHEN h_or_l = 2 THEN {s} END) / nullif(CASE WHEN count({s}) = count(*) THEN sum({s}) END, 0), 0), 6) AS {s}"
                  for s in ('s1', 's2'))}
FROM stated WHERE redox_state = 2 GROUP BY identifier""", "stated")
OX_EFFECT = """
  SELECT x.id, concat(c.a, '-', c.b) AS comparison, y.mean - x.mean AS d
  FROM contrast c JOIN ox_moments x ON x.condition = c.a JOIN ox_moments y ON y.condition = c.b AND y.id = x.id"""
check("change_ox", f"SELECT id, comparison, round(d, 9) AS change_ox FROM ({OX_EFFECT})", "ox_moments", "contrast")
check("change_ox_max", f"SELECT id, round({EXTREME.format('d')}, 9) AS change_ox_max FROM ({OX_EFFECT}) GROUP BY id",
      "ox_moments", "contrast")

# ------------------------------------------------------------------ annotation

check("add_accession", """
SELECT feature, ordinal, identifier, CASE WHEN identifier IS NOT NULL THEN split_part(identifier, '--', 1) END AS accession,
       CASE WHEN identifier IS NOT NULL THEN split_part(identifier, '--', 2) END AS sites FROM phospho""", "phospho")
check("uniprot_entry", "SELECT feature, ordinal, split_part(accession, '|', 2) AS entry FROM peptides", "peptides")
check("label_class", f"SELECT id, count(*) AS n, {CLASS} AS class FROM quant GROUP BY id", "quant")
check("annotate", """
SELECT p.feature, p.ordinal, split_part(p.accession, '|', 2) AS accession, a.go_bp, a.go_mf
FROM peptides p LEFT JOIN annotation a ON split_part(p.accession, '|', 2) = a.entry""", "peptides", "annotation")
check("explode_terms", "SELECT accession, category, term FROM terms", "terms")
check("go_top_terms", """
SELECT category, term, n FROM (
  SELECT *, row_number() OVER (PARTITION BY category ORDER BY n DESC, term) AS rn
  FROM (SELECT category, term, count(*) AS n FROM terms GROUP BY category, term)) WHERE rn <= 5""", "terms")
TERM_COUNTS = "(SELECT category, term, cluster, count(*) AS n FROM terms GROUP BY category, term, cluster)"
check("go_top_terms_by_cluster", f"""
SELECT category, term, cluster, n FROM {TERM_COUNTS} WHERE term IN (
  SELECT term FROM (SELECT *, row_number() OVER (PARTITION BY category, cluster ORDER BY n DESC, term) AS rn
                    FROM {TERM_COUNTS}) WHERE rn <= 2)""", "terms")
check("term_profiles", _frequent_terms("profile", "v.condition, round(v.z, 6) AS z", 250), "profile", "part_terms")
check("term_fold_changes", _frequent_terms("effect", "v.comparison, round(v.fc, 6) AS fc", 200), "effect", "part_terms")
check("term_heatmap", _frequent_terms("moments", "v.condition, round(v.mean, 6) AS scaled", 250), "moments", "part_terms")

# ------------------------------------------------------------------- workflows

view("two_tests", "SELECT * FROM adjusted WHERE comparison IN ('A-N', 'A-R')", "adjusted")
check("protein_workflow", f"""
SELECT t.*, round(v.p, 5) AS "P", round(v.q, 5) AS "FDR", e.fc_max, m.missing
FROM (SELECT id, {', '.join(f"round(max(CASE WHEN comparison = '{c}' THEN {col} END), 5) AS {chr(34)}{c}_{s}{chr(34)}"
                            for c in ('A-N', 'A-R') for col, s in (('p', 'P'), ('q', 'FDR'), ('fc', 'FC')))}
      FROM two_tests GROUP BY id) t
JOIN variance_adjusted v ON t.id = v.id
JOIN (SELECT id, round({EXTREME.format('fc')}, 5) AS fc_max FROM two_tests GROUP BY id) e ON t.id = e.id
LEFT JOIN (SELECT id, string_agg(condition, '-' ORDER BY condition) AS missing
           FROM (SELECT id, condition FROM quant GROUP BY id, condition HAVING sum(abundance) = 0) GROUP BY id) m
  ON t.id = m.id""", "two_tests", "variance_adjusted", "quant")
check("protein_abundance", """
SELECT split_part(accession, ';', 1) AS accession, confidence_score FROM proteins
WHERE description <> 'cRAP' AND peptide_count >= 2 AND unique_peptides >= 1""", "proteins")
check("peptide_workflow", _reduced("(SELECT *, accession || '--' || sequence AS identifier FROM best)", "identifier"), "best")
check("peptide_files_workflow", _reduced("(SELECT *, accession || '--' || sequence AS identifier FROM best)", "identifier"), "best")
SAMPLE_CELLS = ", ".join(f"""CASE WHEN (p.feature + {j}) % 5 = 0 THEN 0.0 ELSE
    p.s1 * CASE WHEN p.ordinal % 4 = 0 THEN {8 if j // 4 == 1 else 1} ELSE 1 END * (10 + (p.ordinal + {7 * j}) % 13) END AS "{s}\"""" for j, s in enumerate(SAMPLES))
view("site_sums", f"""
  SELECT identifier AS id, {', '.join(f'sum("{s}") AS "{s}"' for s in SAMPLES)}
  FROM (SELECT i.identifier, {SAMPLE_CELLS} FROM best p JOIN best_phospho i ON p.feature = i.feature AND p.ordinal = i.ordinal
        WHERE i.identifier IS NOT NULL) GROUP BY identifier""", "best", "best_phospho")
view("site_quant", " UNION ALL ".join(
    f"""SELECT id, '{s[0]}' AS condition, {s[2]} AS replicate, "{s}" AS abundance FROM site_sums""" for s in SAMPLES), "site_sums")
view("site_cleaned", _clean("site_quant", 3), "site_quant")
for derived, source in (("logged", "cleaned"), ("within", "logged"), ("imputed", "within")):
    view(f"site_{derived}", VIEWS[derived][1].replace(source, f"site_{source}"), f"site_{source}")
view("site_moments", _moments("site_imputed"), "site_imputed")
view("site_tested", _tests("site_moments"), "site_moments", "contrast")
view("site_adjusted", _adjusted("site_tested", "comparison"), "site_tested")
check("phospho_analysis", """
SELECT t.id AS identifier, t.comparison, round(fc, 5) AS fc, round(p, 5) AS p_value, round(q, 5) AS fdr, m.missing,
       split_part(split_part(t.id, '--', 1), '|', 2) AS accession, split_part(t.id, '--', 2) AS sites, a.go_bp
FROM site_adjusted t LEFT JOIN (
  SELECT id, string_agg(condition, '-' ORDER BY condition) AS missing
  FROM (SELECT id, condition FROM site_quant GROUP BY id, condition HAVING sum(abundance) = 0) GROUP BY id) m ON m.id = t.id
LEFT JOIN annotation a ON a.entry = split_part(split_part(t.id, '--', 1), '|', 2)""", "site_adjusted", "site_quant", "annotation")
LABEL_CELLS = ", ".join(f"""sum(CASE WHEN (scan + {j}) % 5 = 0 THEN 0.0 ELSE
    s1 * CASE WHEN scan % 4 = 0 THEN {8 if j // 4 == 1 else 1} ELSE 1 END * (10 + (3 * scan + {7 * j}) % 13) END) AS "{s}\"""" for j, s in enumerate(SAMPLES))
SHARES = ", ".join(f"""coalesce(sum(CASE WHEN h_or_l = 2 THEN "{s}" END) / nullif(sum("{s}"), 0), 0) AS "{s}\"""" for s in SAMPLES)
view("share_sums", f"""
  SELECT concat(identifier, '-H') AS id, {SHARES} FROM (
    SELECT label_identifier, any_value(identifier) AS identifier, any_value(h_or_l) AS h_or_l, any_value(redox_state) AS redox_state, {LABEL_CELLS}
    FROM best_stated GROUP BY label_identifier HAVING count(lgp) > 0)
  WHERE redox_state = 2 GROUP BY identifier""", "best_stated")
view("share_quant", " UNION ALL ".join(
    f"""SELECT id, '{s[0]}' AS condition, {s[2]} AS replicate, "{s}" AS abundance FROM share_sums""" for s in SAMPLES), "share_sums")
view("share_logged", _clean("share_quant", 2), "share_quant")  # shares are taken as they are
for derived, source in (("within", "logged"), ("imputed", "within")):
    view(f"share_{derived}", VIEWS[derived][1].replace(source, f"share_{source}"), f"share_{source}")
view("share_moments", _moments("share_imputed"), "share_imputed")
view("share_tested", _tests("share_moments"), "share_moments", "contrast")
view("share_adjusted", _adjusted("share_tested", "comparison"), "share_tested")
check("occupancy_workflow", """
SELECT id AS identifier, comparison, round(fc, 5) AS change_ox, round(p, 5) AS p_value, round(q, 5) AS fdr FROM share_adjusted""", "share_adjusted")
EXPERIMENT = "split_part(id, '/', 1)"
view("both_quant", """
  SELECT 'x/' || id AS id, condition, replicate, abundance FROM quant UNION ALL
  SELECT 'y/' || id, condition, replicate, CASE WHEN condition = 'R' THEN abundance ELSE abundance * 3 END FROM quant""", "quant")
view("both_cleaned", _clean("both_quant", 3), "both_quant")
view("both_logged", VIEWS["logged"][1].replace("cleaned", "both_cleaned"), "both_cleaned")
view("both_within", VIEWS["within"][1].replace("logged", "both_logged"), "both_logged")
view("both_imputed", f"""
  SELECT w.id, w.condition, w.replicate, CASE WHEN w.abundance <> 0 THEN w.abundance ELSE l.level END AS abundance
  FROM both_within w JOIN (
    SELECT {EXPERIMENT} AS e, condition, quantile_cont(CASE WHEN abundance <> 0 THEN abundance END, 0.25) AS level
    FROM both_within GROUP BY 1, 2) l ON w.condition = l.condition AND split_part(w.id, '/', 1) = l.e""", "both_within")
view("both_moments", _moments("both_imputed"), "both_imputed")
view("both_tested", _tests("both_moments"), "both_moments", "contrast")
view("both_adjusted", _adjusted("both_tested", f"comparison, {EXPERIMENT}"), "both_tested")
check("analysis_by_experiment", f"""
SELECT split_part(t.id, '/', 1) AS experiment, split_part(t.id, '/', 2) AS id, comparison, round(fc, 5) AS fc, round(p, 5) AS p_value,
       round(q, 5) AS fdr, round({EXTREME.format('fc').replace('(fc)', '(fc) OVER (PARTITION BY t.id)')}, 5) AS fc_max, missing
FROM both_adjusted t LEFT JOIN (
  SELECT id, string_agg(condition, '-' ORDER BY condition) AS missing
  FROM (SELECT id, condition FROM both_quant GROUP BY id, condition HAVING sum(abundance) = 0) GROUP BY id) m ON m.id = t.id""", "both_adjusted", "both_quant")
check("phospho_workflow", _reduced(_identified("best", "best_phospho"), "identifier"), "best", "best_phospho")
check("redox_workflow", _reduced(_identified("best", "best_redox"), "identifier"), "best", "best_redox")

check("peaks_reduce_features", """
SELECT scan, ordinal, peptide, ptm, lgp, accession, unique_peptides, lgp_protein FROM labelled_best""", "labelled_best")
check("labelled_workflow", _reduced("best_stated", "label_identifier", "scan lgp redox_state", "lgp", "scan", ("s1", "s2"), 5),
      "best_stated")

# ------------------------------------------------------------ readers and sinks

check("read_measurements", """
SELECT CASE WHEN l_orderkey % 50 <> 0 THEN l_orderkey END AS feature,
       CASE WHEN l_linenumber <> 3 THEN l_quantity END AS score, l_returnflag || l_linestatus AS sequence,
       CASE WHEN l_linenumber % 2 = 0 THEN '[2] Phospho (S)' END AS modifications, 'P' || l_partkey AS accession,
       'so-called "P' || l_partkey || '",' || CASE WHEN l_orderkey % 2 = 1 THEN chr(10) ELSE ' ' END || 'line ' || l_linenumber AS description,
       CASE WHEN l_linenumber <> 2 THEN l_extendedprice END AS "Abundance", l_tax AS "Abundance_2"
FROM lineitem""")
check("read_peaks_proteins", """
SELECT 'S' || s_suppkey AS accession, CASE WHEN s_suppkey % 7 <> 0 THEN s_acctbal END AS lgp,
       CAST(s_suppkey % 9 AS INTEGER) AS peptide_count, CAST(s_suppkey % 4 AS INTEGER) AS unique_peptides,
       CASE WHEN s_suppkey % 2 = 0 THEN 'Oxidation' END AS ptm, s_name || ', "kinase"' AS description,
       s_acctbal AS "sample 1", CAST(s_nationkey AS DOUBLE) AS "sample 2"
FROM supplier""")
check("read_peaks_peptides", """
SELECT 'P' || l_partkey AS accession, l_orderkey AS scan, 'K.' || l_returnflag || l_linestatus || '.R' AS peptide,
       CASE WHEN l_linenumber <> 3 THEN l_quantity END AS lgp, CASE WHEN l_linenumber = 1 THEN 'Carbamidomethylation' END AS ptm,
       'C' || l_linenumber || ':Carbamidomethylation:' || l_discount AS ascore, l_extendedprice AS "sample 1"
FROM lineitem""")
LETTERS = "upper(replace(p_name, ' ', ''))"
check("read_fasta", f"SELECT 'sp|P' || p_partkey || '|' || {LETTERS} AS accession, {LETTERS} || reverse({LETTERS}) AS sequence FROM part")
check("read_fasta_pattern", f"SELECT 'P' || p_partkey AS accession, {LETTERS} || reverse({LETTERS}) AS sequence FROM part")
check("read_annotation", """
SELECT 'S' || s_suppkey AS accession,
       CASE WHEN s_suppkey % 11 <> 0 THEN 'process ' || s_nationkey % 5 || ' [GO:000000' || s_nationkey % 5 || ']; process '
            || 5 + s_suppkey % 4 || ' [GO:000000' || 5 + s_suppkey % 4 || ']' END AS go_bp,
       'a deliberately long molecular function name for truncation ' || s_nationkey % 3 || ' [GO:0000010]' AS go_mf
FROM supplier""")
check("read_processed", f"SELECT id, {_wide('abundance')} FROM quant GROUP BY id", "quant")
check("write_table", LONG.format("abundance", "quant"), "quant")
