"""Deterministic per-row randomness: every draw is a function of (seed, id)."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of a published 32-bit integer mixer (shift and multiply rounds).
MIX_SHIFTS = (16, 15, 16)
MIX_MULTIPLIERS = (2146121005, -2073254261)  # the second is 0x846ca68b - 2^32
WORD = 4294967296


def _mixed_number(h: int) -> int:
    for shift, mult in zip(MIX_SHIFTS, MIX_MULTIPLIERS):
        h = ((h ^ (h >> shift)) * mult) % WORD
    return h ^ (h >> MIX_SHIFTS[-1])


def _shifted(h: Column, shift: int) -> Column:
    """h xor h >> shift, with h computed once wherever this stands: a filter shares no subexpressions."""
    return F.get(F.transform(F.array(h), lambda x: x.bitwiseXOR(F.shiftright(x, shift))), F.lit(0))


def _mixed(h: Column) -> Column:
    for shift, mult in zip(MIX_SHIFTS, MIX_MULTIPLIERS):
        h = F.pmod(_shifted(h, shift) * F.lit(mult), F.lit(WORD))
    return _shifted(h, MIX_SHIFTS[-1])


def _mixed_sql(h: str) -> str:
    for shift, mult in zip(MIX_SHIFTS, MIX_MULTIPLIERS):
        h = f"(list_transform([{h}], lambda x: xor(x, x >> {shift}))[1])"
        h = f"((({h} * {mult}) % {WORD} + {WORD}) % {WORD})"
    return f"(list_transform([{h}], lambda x: xor(x, x >> {MIX_SHIFTS[-1]}))[1])"


def _seed_word(seed: int) -> int:
    """Both words of a seed, mixed, so that near seeds give unrelated draws."""
    low, high = int(seed) % WORD, (int(seed) // WORD) % WORD
    return _mixed_number((_mixed_number(high ^ 0x9E3779B9) ^ low) % WORD)


def row_hash(row_id: Column, seed: int = 0) -> Column:
    """32-bit hash of a bigint id, in plain arithmetic any SQL engine can repeat: seed, high and low word are mixed in turn."""
    i = row_id.cast("bigint")
    high = F.pmod(F.shiftright(i, 32), F.lit(WORD))
    return _mixed(_mixed(high.bitwiseXOR(F.lit(_seed_word(seed)))).bitwiseXOR(F.pmod(i, F.lit(WORD))))


def row_hash_sql(expr: str, seed: int = 0) -> str:
    """The same hash as DuckDB SQL text (used by the correctness check), for ids that are not negative."""
    high = f"xor((({expr})::BIGINT >> 32)::BIGINT, {_seed_word(seed)}::BIGINT)"
    return _mixed_sql(f"xor({_mixed_sql(high)}, (({expr}) % {WORD})::BIGINT)")


def draw_words(seed: int, draw: int) -> tuple[int, int]:
    """The words that a draw starts from, one for each 32 bits."""
    start = _seed_word(seed)
    return tuple(_mixed_number(start ^ _mixed_number((2 * int(draw) + k) % WORD)) for k in (1, 2))


def _mixed_array(h: np.ndarray) -> np.ndarray:
    for shift, mult in zip(MIX_SHIFTS, MIX_MULTIPLIERS):
        h = ((h ^ (h >> np.uint64(shift))) * np.uint64(mult % WORD)) & np.uint64(WORD - 1)
    return h ^ (h >> np.uint64(MIX_SHIFTS[-1]))


def hash_array(word: int, *ids: np.ndarray) -> np.ndarray:
    """32-bit hashes of one or more bigint ids: `row_hash` for arrays inside tasks."""
    h = np.uint64(word)
    for i in ids:
        u = np.asarray(i, np.int64).view(np.uint64)
        for part in (u >> np.uint64(32), u & np.uint64(WORD - 1)):
            h = _mixed_array(part ^ h)
    return h


def uniforms(seed: int, draw: int, *ids: np.ndarray) -> np.ndarray:
    """Uniform doubles in [0, 1) from 53 hash bits of (seed, draw, ids), in arithmetic any SQL engine can repeat."""
    high, low = (hash_array(w, *ids) for w in draw_words(seed, draw))
    return ((high >> np.uint64(5)) * np.uint64(1 << 26) + (low >> np.uint64(6))).astype(float) * 2.0**-53


def normals(seed: int, draw: int, *ids: np.ndarray) -> np.ndarray:
    """Standard normals by Box-Muller on two uniforms."""
    return np.sqrt(-2.0 * np.log(1.0 - uniforms(seed, 2 * draw, *ids))) * np.cos(2.0 * np.pi * uniforms(seed, 2 * draw + 1, *ids))


def uniform_sql(seed: int, draw: int, *ids: str) -> str:
    """The same uniforms as DuckDB SQL text, for ids that are not negative."""
    words = []
    for word in draw_words(seed, draw):
        h = f"{word}::BIGINT"
        for i in ids:
            for part in (f"(({i})::BIGINT >> 32)::BIGINT", f"(({i}) % {WORD})::BIGINT"):
                h = _mixed_sql(f"xor({part}, {h})")
        words.append(h)
    return f"((({words[0]} >> 5) * {1 << 26} + ({words[1]} >> 6))::DOUBLE * {2.0**-53!r})"


def normal_sql(seed: int, draw: int, *ids: str) -> str:
    return f"(sqrt(-2.0 * ln(1.0 - {uniform_sql(seed, 2 * draw, *ids)})) * cos(2.0 * pi() * {uniform_sql(seed, 2 * draw + 1, *ids)}))"
