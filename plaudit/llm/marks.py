"""A bitmap of bounded size that keeps most unneeded rows out of a shuffle."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MOST_BITS = 1 << 28


class Marks:
    """A set of 64-bit numbers as a bitmap of bounded size: no member is missed,
    others may pass."""

    def __init__(self, df: DataFrame, number: Column, rows: int, bits_a_row: int = 24):
        bits = 1 << 17
        while bits < bits_a_row * rows and bits < MOST_BITS:
            bits *= 2
        self.bits = bits
        bit = self.bit(number)
        block = 1 << 17

        def pack(key, pdf):
            out = np.zeros(block // 8, np.uint8)
            at = pdf["bit"].to_numpy(np.int64) % block
            np.bitwise_or.at(out, at >> 3, (1 << (at & 7)).astype(np.uint8))
            return pd.DataFrame({"block": [int(key[0])], "body": [out.tobytes()]})

        blocks = (
            df.select(bit.alias("bit")).distinct().withColumn("block", F.floor(F.col("bit") / block))
            .groupBy("block").applyInPandas(pack, "block long, body binary").toPandas()
        )
        self.map = np.zeros(bits // 8, np.uint8)
        for at, body in zip(blocks["block"], blocks["body"], strict=True):
            self.map[int(at) * block // 8 : (int(at) + 1) * block // 8] = np.frombuffer(body, np.uint8)

    def bit(self, number: Column) -> Column:
        return F.pmod(number, F.lit(self.bits).cast("long"))

    def has(self, bits: np.ndarray) -> np.ndarray:
        return (self.map[bits >> 3] >> (bits & 7).astype(np.uint8)) & 1 == 1
