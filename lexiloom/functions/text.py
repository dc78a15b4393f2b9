"""Text expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from lexiloom.config import MAX_LENGTH


def space_length(text: str | Column = "text") -> Column:
    """Number of pieces between single spaces; empty pieces count, other white space does not split."""
    return F.size(F.split(text, " "))


def tokens(text: str | Column = "text") -> Column:
    """Lower-cased pieces between single spaces, without empty ones."""
    return F.array_remove(F.split(F.lower(text), " "), "")


def encoded_length(text: str | Column = "text", max_length: int | None = MAX_LENGTH) -> Column:
    """Number of ids :func:`lexiloom.operators.encode.encode` gives a text, counted without a vocabulary:
    every token becomes one id, known or not, and the start and end ids are added."""
    full = F.size(tokens(text)) + 2
    return full if max_length is None else F.least(full, F.lit(max_length))
