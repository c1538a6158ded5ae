"""Side-by-side run of a registered query and its SQL."""

from __future__ import annotations

import decimal
import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connection(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def _plain(value):
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else float(f"{value:.12g}")
    if isinstance(value, decimal.Decimal):
        return format(value, "f")
    if isinstance(value, (list, tuple)):
        return [_plain(v) for v in value]
    if isinstance(value, dict):
        return {k: _plain(v) for k, v in value.items()}
    return value


def rows(arrow) -> list[str]:
    names = sorted(arrow.column_names)
    columns = [arrow.column(n).to_pylist() for n in names]
    return sorted(repr([_plain(v) for v in row]) for row in zip(*columns))


def types(arrow) -> dict[str, str]:
    plain = {"large_string": "string", "double": "double"}
    out = {}
    for field in arrow.schema:
        text = str(field.type).replace("large_", "")
        text = text.replace("not null", "").replace(" ", "")
        out[field.name] = plain.get(text, text)
    return out


def differences(spark_arrow, oracle_arrow) -> list[str]:
    found = []
    left, right = types(spark_arrow), types(oracle_arrow)
    if sorted(left) != sorted(right):
        found.append(f"columns {sorted(left)} != {sorted(right)}")
        return found
    for name in left:
        if left[name] != right[name]:
            found.append(f"type of {name}: {left[name]} != {right[name]}")
    a, b = rows(spark_arrow), rows(oracle_arrow)
    if len(a) != len(b):
        found.append(f"rows {len(a)} != {len(b)}")
    if a != b:
        only_a = [x for x in a if x not in set(b)][:3]
        only_b = [x for x in b if x not in set(a)][:3]
        found.append(f"values differ: spark only {only_a}, sql only {only_b}")
    return found
