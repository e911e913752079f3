"""Pandas frames for Arrow batches."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

import pandas as pd


def frame(rows: Iterable[Sequence], columns: Sequence[str]) -> pd.DataFrame:
    """Rows as a frame of plain objects: Arrow converts each column to the declared type, whatever it holds."""
    return pd.DataFrame(list(rows), columns=list(columns), dtype=object)
