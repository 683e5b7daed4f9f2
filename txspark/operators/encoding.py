"""Multi-hot encoding of comma-list columns."""

from __future__ import annotations

from functools import reduce
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Columns that an encoding may make.
MOST_COLUMNS = 20_000


def _tokens(column: str):
    return F.split(F.lower(F.col(column)), ",")


def vocabularies(df: DataFrame, columns: list[str]) -> dict[str, list[str]]:
    """Sorted tokens of each comma-list column: lower case, not trimmed; of non-empty values only."""
    found: dict[str, list[str]] = {c: [] for c in columns}
    long = reduce(lambda a, b: a.unionByName(b), [df.where(F.col(c) != "").select(F.lit(c).alias("column"), F.explode(_tokens(c)).alias("token")) for c in columns]).distinct()
    rows = long.limit(MOST_COLUMNS + 1).collect()
    if len(rows) > MOST_COLUMNS:
        raise ValueError(f"the encoding would make over {MOST_COLUMNS} columns")
    for r in rows:
        found[r["column"]].append(r["token"])
    return {c: sorted(v) for c, v in found.items()}


def token_places(df: DataFrame, columns: list[str], vocabulary: dict[str, list[str]], prefix: bool = True, name: str = "places") -> tuple[DataFrame, list[str]]:
    """``df`` with a sorted array of the places of each row's tokens among the encoded columns, in place of the comma lists, and the names of these columns.

    Tokens are looked up in one map for each list, so that a row costs as many look-ups as it has tokens, however many columns there are. The array is the
    sparse form of the row; ``dense`` makes columns of it. The maps have at most MOST_COLUMNS entries and travel with the tasks.
    """
    named = lambda c, token: f"{c.split('_')[-1]}_{token}" if prefix else token
    names = sorted({named(c, t) for c in columns for t in vocabulary[c]})
    at = {n: i for i, n in enumerate(names)}
    maps = [{t: at[named(c, t)] for t in vocabulary[c]} for c in columns]

    @F.pandas_udf(T.ArrayType(T.IntegerType()))
    def places(lists: pd.DataFrame) -> pd.Series:
        found = [sorted({m[t] for m, own in zip(maps, row, strict=True) if own is not None for t in own if t in m}) for row in lists.itertuples(index=False, name=None)]
        return pd.Series(found, dtype=object)

    lists = F.struct(*[F.when(F.col(f"`{c}`") != "", _tokens(f"`{c}`")).alias(f"l{i}") for i, c in enumerate(columns)])
    kept = [F.col(f"`{c}`") for c in df.columns if c not in columns]
    return df.select(*kept, (places(lists) if names else F.array().cast("array<int>")).alias(name)), names


def dense(df: DataFrame, names: list[str], places: str = "places") -> DataFrame:
    """A boolean column for each name, true where its place is in the array: one array of flags a row, read by place."""

    @F.pandas_udf(T.ArrayType(T.BooleanType()))
    def flags(own: pd.Series) -> pd.Series:
        out = []
        for row in own:
            held = np.zeros(len(names), bool)
            held[np.asarray(row, np.int64)] = True
            out.append(held)
        return pd.Series(out, dtype=object)

    kept = [F.col(f"`{c}`") for c in df.columns if c != places]
    if not names:
        return df.select(*kept)
    # the flags are a column before they are read, so that they are made once for a row
    flagged = df.select(*kept, flags(places).alias("_flags"))
    return flagged.select(*kept, *[F.col("_flags")[i].alias(n) for i, n in enumerate(names)])


def multi_hot(df: DataFrame, columns: list[str], prefix: bool = True, vocabulary: dict[str, list[str]] | None = None) -> DataFrame:
    """A boolean column for each token instead of the comma-list columns (ENC1).

    With ``prefix`` a name starts with the last part of its source column (ENC2). Columns of one name are joined by or (ENC3). A
    source without tokens vanishes.
    """
    sparse, names = token_places(df, columns, vocabulary or vocabularies(df, columns), prefix, "_places")
    return dense(sparse, names, "_places")


def _column_of(prefix: str):
    """The sanitised column name of a token."""
    return lambda token: F.btrim(F.regexp_replace(F.regexp_replace(F.concat(F.lit(prefix), token), "[^a-zA-Z0-9_]", "_"), "__+", "_"), F.lit("_"))


def encode_for_schema(df: DataFrame, schema: dict[str, str], keys: tuple[str, ...] = ("transcript_id",)) -> DataFrame:
    """Comma-list columns become the boolean columns of a model's schema that start with the last part of their names; the schema is the vocabulary.

    Tokens are compared in lower case and as sanitised names. A column that the schema itself has, or that no name of it starts with, stays.
    """
    made: dict[str, list] = {}
    gone = []
    for f in df.schema.fields:
        prefix = f.name.split("_")[-1] + "_"
        names = [n for n in schema if n.startswith(prefix)]
        if isinstance(f.dataType, T.StringType) and f.name not in (*keys, *schema) and names:
            gone.append(f.name)
            held = F.transform(F.coalesce(_tokens(f"`{f.name}`"), F.array()), _column_of(prefix))
            for n in names:
                made.setdefault(n, []).append(F.array_contains(held, n))
    made = {n: tests + ([F.col(f"`{n}`").cast("boolean")] if n in df.columns else []) for n, tests in made.items()}
    kept = [F.col(f"`{c}`") for c in df.columns if c not in gone and c not in made]
    return df.select(*kept, *[reduce(lambda a, b: a | b, tests).alias(n) for n, tests in made.items()])


def merge_agreeing(df: DataFrame, columns: list[str]) -> DataFrame:
    """Columns with one name after the first ``_`` that are equal in every row become ``merged_<name>`` (ENC4)."""
    groups: dict[str, list[str]] = {}
    for c in columns:
        if "_" in c:
            groups.setdefault(c.split("_", 1)[1], []).append(c)
    groups = {k: v for k, v in groups.items() if len(v) > 1}
    if not groups:
        return df
    equal = df.agg(*[F.bool_and(reduce(lambda a, b: a & b, [F.col(f"`{x}`").eqNullSafe(F.col(f"`{y}`")) for x, y in combinations(v, 2)])).alias(f"m{i}") for i, v in enumerate(groups.values())]).first()
    merged = {k: v for i, (k, v) in enumerate(groups.items()) if equal[i]}
    gone = {c for v in merged.values() for c in v}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c not in gone], *[F.col(f"`{v[0]}`").alias(f"merged_{k}") for k, v in merged.items()])
