"""Invented prose for the tests."""

from __future__ import annotations

import os
import random

SF = os.environ.get("TXNRISK_SF_DIR", "/root/testdata/sf0.01")


def prose(seed: int, words: int, stock: int = 400) -> str:
    draw = random.Random(seed)
    pool = ["".join(random.Random(i).choices("abcdefghiklmnoprstu", k=3 + i % 7)) for i in range(stock)]
    return " ".join(draw.choice(pool) for _ in range(words))
