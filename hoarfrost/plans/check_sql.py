"""Pieces of the checking SQL. Amounts are exact decimals, so that results do not depend on
the order of addition; quotients are rounded half away from zero in whole numbers."""

from __future__ import annotations


def dec(expr: str) -> str:
    return f"CAST({expr} AS DECIMAL(18,4))"


def total(expr: str, kind: str = "DECIMAL(28,4)") -> str:
    return f"CAST(sum({expr}) AS {kind})"


def big(expr: str) -> str:
    return f"CAST({expr} AS BIGINT)"


def small(expr: str) -> str:
    return f"CAST({expr} AS SMALLINT)"


def key_of(expr: str) -> str:
    return f"CAST(strftime({expr}, '%Y%m%d') AS INTEGER)"


def month_of(expr: str) -> str:
    return f"CAST(strftime({expr}, '%Y%m') AS BIGINT)"


def whole_quotient(top: str, base: str) -> str:
    """top / base as a whole number, half away from zero; NULL when the base is 0."""
    return (
        f"(CASE WHEN ({base}) = 0 THEN NULL WHEN (({top}) < 0) <> (({base}) < 0) "
        f"THEN -((2 * abs({top}) + abs({base})) // (2 * abs({base}))) "
        f"ELSE (2 * abs({top}) + abs({base})) // (2 * abs({base})) END)"
    )


def units(expr: str, scale: int = 4) -> str:
    """A decimal as a whole number of its smallest unit."""
    return f"CAST(({expr}) * {10**scale} AS HUGEINT)"


def from_units(expr: str, precision: int, scale: int) -> str:
    tiny = "0." + "0" * (scale - 1) + "1"
    whole = min(38 - scale, 28)
    return (
        f"CAST(CAST({expr} AS DECIMAL({whole},0)) * CAST({tiny} AS DECIMAL({scale},{scale})) "
        f"AS DECIMAL({precision},{scale}))"
    )


def average(expr: str, precision: int = 22, scale_in: int = 4, scale_out: int = 8) -> str:
    up = 10 ** (scale_out - scale_in)
    return from_units(
        whole_quotient(f"sum({units(expr, scale_in)}) * {up}", f"CAST(count({expr}) AS HUGEINT)"), precision, scale_out
    )


def quotient(top_units: str, base_units: str, precision: int, scale: int, factor: int = 1, steps: int = 10) -> str:
    """Quotient of two totals in units: at `steps` digits, times the factor, then rounded."""
    fine = f"{whole_quotient(f'({top_units}) * {10**steps}', base_units)} * {factor}"
    return from_units(whole_quotient(fine, f"CAST({10 ** (steps - scale)} AS HUGEINT)"), precision, scale)


def share(part: str, whole: str) -> str:
    """A count as a percentage of another, at fourteen digits and then at four."""
    fine = whole_quotient(f"CAST({part} AS HUGEINT) * {100 * 10**14}", f"CAST({whole} AS HUGEINT)")
    return from_units(whole_quotient(fine, f"CAST({10**10} AS HUGEINT)"), 9, 4)


def bucket(expr: str, digits: int = 3) -> str:
    return f"substr(sha256({expr}), 1, {digits})"


def hash_number(expr: str) -> str:
    return f"CAST('0x' || substr(sha256({expr}), 1, 8) AS BIGINT)"


def code_key(expr: str, codes) -> str:
    whens = " ".join(f"WHEN '{c}' THEN {n}" for n, c in enumerate(codes, 1))
    return f"CAST(CASE {expr} {whens} ELSE -1 END AS INTEGER)"
