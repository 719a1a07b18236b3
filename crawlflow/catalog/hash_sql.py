"""XXH64 (seed 0) of ASCII texts in plain SQL, to check the hash expression with.

Follows the published algorithm: four lanes over 32-byte stripes, then the rest
in steps of 8, 4 and 1 bytes. Each step is a level of a recursive query.
"""

from __future__ import annotations

_MOD = "18446744073709551616::UHUGEINT"
# The five primes of the algorithm.
_P1 = 11400714785074694791
_P2 = 14029467366897019727
_P3 = 1609587929392839161
_P4 = 9650029242287828579
_P5 = 2870177450012600261


def _n(value: int) -> str:
    return f"{value % 2**64}::UHUGEINT"


def _mul(a: str, b: str) -> str:
    return f"(({a}) * ({b}) % {_MOD})"


def _add(a: str, b: str) -> str:
    return f"((({a}) + ({b})) % {_MOD})"


def _rotl(x: str, bits: int) -> str:
    return f"(({x}) * {_n(2**bits)} % {_MOD} + ({x}) // {_n(2 ** (64 - bits))})"


def _round(acc: str, lane: str) -> str:
    return _mul(_rotl(_add(acc, _mul(lane, _n(_P2))), 31), _n(_P1))


def _bytes(position: str, size: int) -> str:
    parts = (f"ascii(substr(s, {position} + {j}, 1))::UHUGEINT * {_n(256**j)}" for j in range(size))
    return f"({' + '.join(parts)})"


def _mix(h: str, value: str) -> str:
    return _add(_mul(f"xor({h}, {_round(_n(0), value)})", _n(_P1)), _n(_P4))


def xxh64_ctes(source: str) -> str:
    """CTEs ending in `hashed(s, hash)`, for the distinct texts `s` of the query `source`."""
    start = (_n(_P1 + _P2), _n(_P2), _n(0), _n(-_P1))
    lanes = ", ".join(_round(v, _bytes(f"i * 32 + {1 + 8 * k}", 8)) for k, v in enumerate("abcd"))
    rotated = [_rotl(v, bits) for v, bits in zip("abcd", (1, 7, 12, 18), strict=True)]
    summed = _add(_add(rotated[0], rotated[1]), _add(rotated[2], rotated[3]))
    merges = ",\n".join(
        f"merge{k + 1} AS (SELECT * EXCLUDE (h), CASE WHEN n >= 32 THEN {_mix('h', v)} ELSE h END AS h FROM merge{k})"
        for k, v in enumerate("abcd")
    )
    eight = _add(_mul(_rotl(f"xor(h, {_round(_n(0), _bytes('pos', 8))})", 27), _n(_P1)), _n(_P4))
    four = _add(_mul(_rotl(f"xor(h, {_mul(_bytes('pos', 4), _n(_P1))})", 23), _n(_P2)), _n(_P3))
    one = _mul(_rotl(f"xor(h, {_mul(_bytes('pos', 1), _n(_P5))})", 11), _n(_P1))
    return f"""
    texts AS (SELECT DISTINCT s, length(s) AS n FROM ({source}) WHERE s IS NOT NULL),
    striped(s, n, i, a, b, c, d) AS (
      SELECT s, n, 0, {", ".join(start)} FROM texts
      UNION ALL SELECT s, n, i + 1, {lanes} FROM striped WHERE i < n // 32),
    merge0 AS (SELECT s, n, a, b, c, d, CASE WHEN n >= 32 THEN {summed} ELSE {_n(_P5)} END AS h
      FROM striped WHERE i = n // 32),
    {merges},
    tail(s, n, pos, h) AS (
      SELECT s, n, n // 32 * 32 + 1, {_add("h", "n::UHUGEINT")} FROM merge4
      UNION ALL SELECT s, n, pos + CASE WHEN n + 1 - pos >= 8 THEN 8 WHEN n + 1 - pos >= 4 THEN 4 ELSE 1 END,
        CASE WHEN n + 1 - pos >= 8 THEN {eight} WHEN n + 1 - pos >= 4 THEN {four} ELSE {one} END
      FROM tail WHERE pos <= n),
    fold1 AS (SELECT s, {_mul(f"xor(h, h // {_n(2**33)})", _n(_P2))} AS h FROM tail WHERE pos = n + 1),
    fold2 AS (SELECT s, {_mul(f"xor(h, h // {_n(2**29)})", _n(_P3))} AS h FROM fold1),
    fold3 AS (SELECT s, xor(h, h // {_n(2**32)}) AS h FROM fold2),
    hashed AS (SELECT s, CAST(CASE WHEN h >= {_n(2**63)} THEN h::HUGEINT - 18446744073709551616::HUGEINT
      ELSE h::HUGEINT END AS BIGINT) AS hash FROM fold3)"""
