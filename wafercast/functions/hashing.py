"""Deterministic hash keys.

Every sampling step orders rows by ``md5('<seed>|<id>')`` and draws numbers in
[0, 1) from hex digits of an md5, so results repeat across runs, executors and
engines (DuckDB computes the same md5)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .constants import SEED

_TWO_POW_52 = float(2 ** 52)


def rank_key(id_col: Column | str, seed: int = SEED) -> Column:
    """Hex md5 of ``'<seed>|<id>'``: the sort key for hash-ranked sampling."""
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.md5(F.concat(F.lit(f"{seed}|"), c.cast("string")))


def uniform(*parts: Column | str, seed: int = SEED, tag: str = "u") -> Column:
    """A number in [0, 1) from the first 13 hex digits (52 bits) of
    ``md5('<seed>|<tag>|p1|p2...')``."""
    cols = [F.col(p) if isinstance(p, str) else p for p in parts]
    h = F.md5(F.concat_ws("|", F.lit(str(seed)), F.lit(tag), *[c.cast("string") for c in cols]))
    return F.conv(F.substring(h, 1, 13), 16, 10).cast("bigint") / F.lit(_TWO_POW_52)
