"""The longest substring that barcodes share with a primer; Arrow batches, as ties need exact rules."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def longest_shared(barcode: str, primer: str) -> tuple[int, int]:
    """(length, end in the barcode) of the longest common substring; ties: earliest in the primer, then in the barcode."""
    for n in range(min(len(barcode), len(primer)), 0, -1):
        for i in range(len(primer) - n + 1):
            at = barcode.find(primer[i : i + n])
            if at >= 0:
                return n, at + n
    return 0, 0


def primer_overlap(barcode: Column, primer: str) -> Column:
    @F.pandas_udf("length int, end int")
    def find(s: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([longest_shared(x or "", primer) for x in s], columns=["length", "end"])

    return find(barcode)
