"""Assembles one DuckDB statement from named CTEs: only those a query mentions, in order."""

from __future__ import annotations

import re


def q(columns: str, source: str, tail: str = "") -> str:
    """SELECT with typed outputs: ``name#d`` double, ``#t`` timestamp text, ``#y`` date text."""
    forms = {
        "d": "cast({c} as double)",
        "t": "strftime({c}, '%Y-%m-%d %H:%M:%S.%f')",
        "y": "strftime({c}, '%Y-%m-%d')",
        "i": "cast({c} as integer)",
        "l": "cast({c} as bigint)",
    }
    parts = []
    for token in columns.replace(",", " ").split():
        name, _, form = token.partition("#")
        parts.append(f"{forms[form].format(c=name)} as {name}" if form else name)
    return f"select {', '.join(parts)} from {source} {tail}"


def statement(body: str, ctes: dict[str, str]) -> str:
    order: list[str] = []

    def visit(sql: str) -> None:
        for name in re.findall(r"[a-z][a-z0-9_]*", sql):
            if name in ctes and name not in order and name not in path:
                path.append(name)
                visit(ctes[name])
                path.pop()
                order.append(name)

    path: list[str] = []
    visit(body)
    if not order:
        return body
    return "with " + ",\n".join(f"{n} as ({ctes[n]})" for n in order) + "\n" + body


def num(c: str, p: int = 18, s: int = 2) -> str:
    return f"try_cast(trim({c}) as decimal({p},{s}))"


def whole(c: str) -> str:
    return f"try_cast(try_cast(trim({c}) as decimal(38,0)) as integer)"


def real(c: str) -> str:
    return f"try_cast(trim({c}) as double)"


def day(c: str) -> str:
    return f"case when regexp_matches(trim({c}), '^\\d{{4}}-\\d{{2}}-\\d{{2}}$') then try_cast(trim({c}) as date) end"


def flag(c: str) -> str:
    return f"coalesce(upper(trim({c})) in ('TRUE', '1', 'YES'), false)"


def stamp(c: str) -> str:
    n = f"try_cast(trim({c}) as decimal(28,6))"
    iso = ("^\\d{4}-\\d{1,2}-\\d{1,2}([T ]\\d{1,2}:\\d{1,2}:\\d{1,2}(\\.\\d{1,6})?)?$"
           "|^\\d{4}-\\d{1,2}-\\d{1,2}T\\d{1,2}:\\d{1,2}:\\d{1,2}(Z|[+-]\\d{2}:?\\d{2})$")
    return (
        f"case when {n} > 1000000000000000000 then make_timestamp(cast(cast({n} as hugeint) // 1000 as bigint))"
        f" when {n} > 1000000000000000 then make_timestamp(cast(floor({n}) as bigint))"
        f" when {n} > 1000000000000 then make_timestamp(cast(floor({n} * 1000) as bigint))"
        f" when {n} > 1000000000 then make_timestamp(cast(cast({n} as decimal(18,6)) * 1000000 as bigint))"
        f" when {n} is null and regexp_matches(trim({c}), '{iso}')"
        f" then try_cast(regexp_replace(trim({c}), '(Z|[+-]\\d{{2}}:?\\d{{2}})$', '') as timestamp) end"
    )


def hashed(*cs: str) -> str:
    return "md5(concat_ws('|', " + ", ".join(f"coalesce(trim({c}), '')" for c in cs) + "))"


def key(*cs: str) -> str:
    return "md5(concat_ws('-', " + ", ".join(f"coalesce(cast({c} as varchar), '_null_')" for c in cs) + "))"


def dkey(c: str, missing: str | None = "-1") -> str:
    k = f"cast(strftime({c}, '%Y%m%d') as integer)"
    return k if missing is None else f"coalesce({k}, {missing})"


def days(a: str, b: str) -> str:
    return f"cast(coalesce(abs(floor((epoch_us({a}) - epoch_us({b})) / 86400000000.0)), 0) as integer)"
