"""Arithmetic on array columns, in double precision and inside code generation's reach."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def doubles(v: str) -> Column:
    return F.col(v).cast("array<double>")


def dot(a: str, b: str) -> Column:
    return F.expr(f"aggregate(zip_with({a}, {b}, (p, q) -> p * q), 0D, (s, v) -> s + v)")


def norm(a: str) -> Column:
    return F.sqrt(dot(a, a))


def distance(a: str, b: str) -> Column:
    return F.expr(f"sqrt(aggregate(zip_with({a}, {b}, (p, q) -> (p - q) * (p - q)), 0D, (s, v) -> s + v))")


def minus(a: str, b: str) -> Column:
    return F.expr(f"zip_with({a}, {b}, (p, q) -> p - q)")


def project_out(v: str, direction: str) -> Column:
    """V minus its part along a unit vector."""
    return F.expr(f"zip_with({v}, transform({direction}, l -> l * aggregate(zip_with({v}, {direction}, (p, q) -> p * q), 0D, (s, t) -> s + t)), (p, q) -> p - q)")
