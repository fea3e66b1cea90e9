"""Workflows and derived input views."""
