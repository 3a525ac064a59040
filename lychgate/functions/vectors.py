"""Arithmetic of number lists, element by element. Lists of unequal length give null, and so does an element that
is divided by zero."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def both(a: Column, b: Column, use: Callable[[Column, Column], Column]) -> Column:
    return F.when(F.size(a) == F.size(b), F.zip_with(a, b, use))


def plus(a: Column, b: Column) -> Column:
    return both(a, b, lambda x, y: x + y)


def minus(a: Column, b: Column) -> Column:
    return both(a, b, lambda x, y: x - y)


def times(a: Column, b: Column) -> Column:
    return both(a, b, lambda x, y: x * y)


def over(a: Column, b: Column) -> Column:
    return both(a, b, F.try_divide)


def greatest(a: Column, b: Column) -> Column:
    return both(a, b, lambda x, y: F.greatest(x, y))


def least(a: Column, b: Column) -> Column:
    return both(a, b, lambda x, y: F.least(x, y))


def scaled(a: Column, by: Column, use: Callable[[Column, Column], Column]) -> Column:
    """A list with one number on each element."""
    return F.transform(a, lambda x: use(x, by))


def power(base: Column, a: Column) -> Column:
    """One number raised to each element."""
    return F.transform(a, lambda x: F.pow(base, x))


def inverse(a: Column) -> Column:
    return F.transform(a, lambda x: F.try_divide(F.lit(1.0), x))


def negative(a: Column) -> Column:
    return F.transform(a, lambda x: -x)


def sorted_with(a: Column, value: Column) -> Column:
    """A sorted list with one more value at its place."""
    return F.array_sort(F.array_append(a, value))


def without_at(a: Column, place: int) -> Column:
    """A list without the element at a place from 1."""
    return F.filter(a, lambda x, i: i != place - 1)
