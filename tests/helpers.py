def physical(df) -> str:
    text = df._jdf.queryExecution().executedPlan().toString()
    return text.split("Initial Plan")[-1]


def exchanges(df) -> int:
    return sum(1 for line in physical(df).splitlines() if "Exchange hashpartitioning" in line
               or "Exchange rangepartitioning" in line or "Exchange SinglePartition" in line)


def rows(df, *order):
    ordered = df.orderBy(*order) if order else df
    return [tuple(r) for r in ordered.collect()]
