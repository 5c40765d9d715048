"""Reproducible draws from a row key.

Every draw is an expression on the key, so it needs no shuffle and does not
depend on how the table is partitioned, and a lost task repeats it exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .columns import as_list, col

SPACE = 1 << 32  # the first eight hexadecimal digits of the digest


def key_text(key: str | list[str]) -> Column:
    # a missing key draws as well, so no row falls out of both sides of a split
    parts = [F.coalesce(col(k).cast("string"), F.lit("\0")) for k in as_list(key)]
    return parts[0] if len(parts) == 1 else F.concat_ws("|", *parts)


def digest(key: str | list[str], salt: object) -> Column:
    """Eight hexadecimal digits drawn from the key; the salt selects the draw."""
    return F.substring(F.md5(F.concat(key_text(key), F.lit(f"-{salt}"))), 1, 8)


def cut(share: float) -> str:
    """Digest below which the given share of the keys falls."""
    return f"{min(SPACE - 1, int(share * SPACE)):08x}"


def below(key: str | list[str], share: float, salt: object) -> Column:
    if share >= 1:
        return F.lit(True)
    return digest(key, salt) < F.lit(cut(share))


def fold_number(key: str | list[str], folds: int, salt: object) -> Column:
    """Fold 0 .. folds-1 of the key; the salt keeps it independent of a split."""
    draw = digest(key, f"fold-{salt}")
    out = F.lit(0)
    for i in range(1, folds):
        out = out + (draw >= F.lit(cut(i / folds))).cast("int")
    return out


def draw_int(key: str | list[str], field: str, size: int, seed: int, how: str = "xxhash64") -> Column:
    """Uniform integer in ``0 .. size-1`` for one field of one row.

    ``xxhash64`` is the quick form; ``md5`` gives values other engines repeat.
    """
    if how == "md5":
        return F.conv(digest(key, f"{field}-{seed}"), 16, 10).cast("bigint") % F.lit(size)
    return F.pmod(F.xxhash64(key_text(key), F.lit(field), F.lit(seed)), F.lit(size))
