"""Secret scanning of whole texts with regular expressions and windowed entropy (native)."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Base rules. The value is group 1 of ASSIGN and must have LEAST_VALUE characters; the other two hold their length themselves.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_HINT = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]"""
ACCESS = r"AKIA[A-Z0-9]{12,}+"
HEX = r"(?<![0-9a-f])[0-9a-f]{32,}+"
LEAST_VALUE = 8

#: Candidates of the entropy rule: whole runs of the characters that keys are written in.
KEY_CHARS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
CANDIDATE = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}+"
WINDOW = 20
#: Classes of characters in order; the first that covers a candidate sets the bits a character that one of its windows must reach.
CLASSES = ((r"^[0-9a-f]+$", 3.0), (r"^[0-9A-F]+$", 3.0), (r"^[A-Za-z]+$", 3.9), (r"", 3.6))
#: Candidates that are no secrets: one word in lower, upper or title case, words joined by marks or capitals, numbers, rows of marks.
#: Letters that change case at random are no words, so keys without a digit are left to the entropy of their windows.
ALLOWED = (r"^[A-Z]?[a-z]+$", r"^[A-Z]+$", r"^(?:[-_/=+]+|[A-Z]+(?![a-z])|[A-Z]?[a-z]{2,}|(?<![A-Za-z])[a-z](?![A-Za-z]))++$", r"^[0-9]+$", r"^[-_=+/0-9]+$")

KINDS = ("assign", "access", "hex", "entropy")
CHUNK = 256
SPAN = "struct<start:int,kind:int,end:int,value:string>"


def _let(value: Column, body) -> Column:
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _spans(text: Column, pattern: str, kind: int, group: int = 0) -> Column:
    """Non-overlapping matches from the left as structs of start and end in code points.

    The pieces between matches give the places. Running sums are kept in chunks, so that a text
    with very many matches costs little more than in proportion to their number.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    parts = F.arrays_zip(
        F.transform(F.split(text, pattern, -1), F.length).alias("gap"),
        F.transform(found, F.length).alias("len"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(group)).alias("value"),
    )

    def chunk_of(chunks: Column) -> Column:
        total = lambda c: F.aggregate(c, F.lit(0), lambda s, p: s + p["gap"] + F.coalesce(p["len"], F.lit(0)))

        def placed(sums: Column) -> Column:
            def one(c: Column, k: Column) -> Column:
                base = F.aggregate(F.slice(sums, F.lit(1), k), F.lit(0), lambda s, v: s + v)
                zero = F.struct(base.alias("at"), F.array().cast(f"array<{SPAN}>").alias("out"))

                def step(acc: Column, p: Column) -> Column:
                    start = acc["at"] + p["gap"]
                    end = start + p["len"]
                    span = F.struct(start.alias("start"), F.lit(kind).alias("kind"), end.alias("end"), p["value"].alias("value"))
                    return F.struct(end.alias("at"), F.concat(acc["out"], F.array(span)).alias("out"))

                return F.aggregate(F.filter(c, lambda p: p["len"].isNotNull()), zero, step, lambda acc: acc["out"])

            return F.flatten(F.transform(chunks, one))

        return _let(F.transform(chunks, total), placed)

    chunks = _let(parts, lambda x: F.transform(F.sequence(F.lit(1), F.size(x), F.lit(CHUNK)), lambda s: F.slice(x, s, F.lit(CHUNK))))
    return _let(chunks, chunk_of)


def window_entropy(value: Column, window: int = WINDOW) -> Column:
    """The largest Shannon entropy, in bits a character, of the windows of ``window`` key characters in a string.

    One pass: the count of each character in the window and the sum of count * log2(count) follow from those of the window
    before, by the character that enters and the one that leaves. Strings shorter than the window give -1.
    """
    weight = F.array(*[F.lit(float(c * math.log2(c)) if c else 0.0) for c in range(window + 2)])
    places = F.transform(F.split(value, ""), lambda c: F.instr(F.lit(KEY_CHARS), c) - 1)

    def over(chars: Column) -> Column:
        zero = F.struct(F.array_repeat(F.lit(0), len(KEY_CHARS)).alias("counts"), F.lit(0.0).alias("sum"), F.lit(-1.0).alias("top"))

        def step(acc: Column, i: Column) -> Column:
            new, old = F.get(chars, i), F.coalesce(F.get(chars, F.when(i >= window, i - window).otherwise(F.lit(-1))), F.lit(-1))
            entered, left = F.get(acc["counts"], new), F.get(acc["counts"], old)
            change = (
                F.when(new == old, F.lit(0.0))
                .when(old < 0, F.get(weight, entered + 1) - F.get(weight, entered))
                .otherwise(F.get(weight, entered + 1) - F.get(weight, entered) + F.get(weight, left - 1) - F.get(weight, left))
            )
            counts = F.transform(acc["counts"], lambda v, k: v + F.when(k == new, 1).otherwise(0) - F.when(k == old, 1).otherwise(0))
            return _let(
                acc["sum"] + change,
                lambda s: F.struct(counts.alias("counts"), s.alias("sum"), F.when(i >= window - 1, F.greatest(acc["top"], F.lit(math.log2(window)) - s / window)).otherwise(acc["top"]).alias("top")),
            )

        return F.aggregate(F.sequence(F.lit(0), F.size(chars) - 1), zero, step, lambda acc: acc["top"])

    return _let(places, over)


def _is_secret(value: Column) -> Column:
    allowed = F.lit(False)
    for pattern in ALLOWED:
        allowed = allowed | value.rlike(pattern)
    least = F.lit(None).cast("double")
    for pattern, bits in reversed(CLASSES):
        least = F.when(value.rlike(pattern), F.lit(bits)).otherwise(least)
    return F.when(allowed, F.lit(False)).otherwise(window_entropy(value) >= least)


def secret_spans(text: Column) -> Column:
    """All spans of a text, sorted by start, then kind: array of (start, kind, end, value).

    ``kind`` is a place in KINDS. Null or empty text has none. Each kind's pattern is only matched where a cheap test says
    that it can match.
    """
    text = F.coalesce(text, F.lit(""))
    none = F.array().cast(f"array<{SPAN}>")
    assign = F.when(text.rlike(ASSIGN_HINT), F.filter(_spans(text, ASSIGN, 0, 1), lambda s: F.length(s["value"]) >= LEAST_VALUE)).otherwise(none)
    access = F.when(text.contains("AKIA"), _spans(text, ACCESS, 1)).otherwise(none)
    hexes = F.when(text.rlike(HEX), _spans(text, HEX, 2)).otherwise(none)
    entropy = F.when(text.rlike(CANDIDATE), F.filter(_spans(text, CANDIDATE, 3), lambda s: _is_secret(s["value"]))).otherwise(none)
    return F.array_sort(F.concat(assign, access, hexes, entropy))


def span_string(spans: Column) -> Column:
    """``kind:start:end`` of each span, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def scan_secrets(docs: DataFrame) -> DataFrame:
    """``docs`` with a column ``secret_spans``; no shuffle. A column of that name is replaced."""
    return docs.withColumn("secret_spans", secret_spans(F.col("text")))


def redact(docs: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every secret span of the text replaced by ``mark`` and n_chars set to the new length.

    Overlapping or touching spans become one mark. All rows stay; null text stays null; texts without spans, and their
    n_chars, stay as they are; other columns stay.
    """
    spans, text = F.col("spans"), F.col("row.text")
    zero = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        fresh = F.concat(acc["out"], F.substring(text, acc["at"] + 1, s["start"] - acc["at"]), F.lit(mark))
        joins = (s["start"] <= acc["at"]) & (acc["at"] > 0)
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), F.when(joins, acc["out"]).otherwise(fresh).alias("out"))

    clean = F.aggregate(spans, zero, step, lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text))))
    # the row travels as one value, so that no column of the caller's has a name of ours
    found = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), secret_spans(F.col("text")).alias("spans"))
    put = found.select("row", "spans", F.when(F.size("spans") > 0, clean).otherwise(text).alias("put"))
    new = {"text": F.col("put"), "n_chars": F.when(F.size("spans") > 0, F.length("put").cast("long")).otherwise(F.col("row.n_chars"))} if "n_chars" in docs.columns else {"text": F.col("put")}
    return put.select(*[new.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])
