"""Transcript parsing: a hidden Markov model recovers the roles of turns by Viterbi; turns are rendered alike.

A turn shows a speaker marker (or none), the number and form of its lines, and its length. States are roles. Start,
transition and feature probabilities are smoothed counts over labelled conversations, made by Spark. A conversation
is cut at every ``SEGMENT``-th turn number. A segment yields the best score between any two roles (a max-plus matrix), a
conversation's few matrices fix the roles at the cuts, and each segment fills in the rest. So the best path of a
conversation of any length is exact, and no task holds one whole.
"""

from __future__ import annotations

import math
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROLES = ("system", "user", "assistant")
SEGMENT = 65_536
#: Speaker markers at the start of a turn, by role; a fixed list of common forms.
MARKERS = {
    "system": r"(?:system|sys|instructions?)",
    "user": r"(?:user|human|customer|question|q|me|you)",
    "assistant": r"(?:assistant|ai|bot|agent|model|answer|a|gpt|chatbot)",
}
#: A marker needs a colon or bracket behind it, or a heading sign, bracket or stars before it: a word alone is text.
_SIGNED = r"(?:###\s*|\*\*|\[|<\|?|>\s*)?(?:{0})(?:\*\*|\]|\|?>)?\s*(?:[:>\]]|\*\*:?)"
_HEADED = r"(?:###\s*|\*\*|\[|<\|?)(?:{0})(?:\*\*|\]|\|?>)?\s*(?:$|\n)"
_FORM = rf"(?i)^\s*(?:{_SIGNED}|{_HEADED})\s*"
#: Prior counts of a role showing its own marker and another role's: a marker weighs more than any transition.
OWN_MARKER, OTHER_MARKER = 1_000, 0.001
#: Numbers of values of the features, in order: marker, lines, length, question, list.
SIZES = (4, 5, 16, 2, 2)


class Model(NamedTuple):
    """Log probabilities: of the first role, of a role after a role, and of each feature value by role."""

    start: tuple
    step: tuple
    emit: tuple


def _any_marker() -> str:
    return _FORM.format("|".join(MARKERS.values()))


def features(text: str = "text") -> list[Column]:
    """Numbers of the feature values, each below its entry in ``SIZES``."""
    content = F.coalesce(F.col(text), F.lit(""))
    marker = F.lit(0)
    for i, role in enumerate(ROLES):
        marker = F.when(content.rlike(_FORM.format(MARKERS[role])), i + 1).otherwise(marker)
    lines = F.least(F.size(F.split(content, "\n")), F.lit(SIZES[1])) - 1
    length = F.least(F.floor(F.log2(F.length(content) + 1)), F.lit(SIZES[2] - 1))
    question = content.rlike(r"\?\s*$").cast("int")
    listed = content.rlike(r"(?m)^\s*(?:[-*•]|[0-9]+[.)])\s").cast("int")
    return [c.cast("int").alias(f"f{i}") for i, c in enumerate([marker, lines, length, question, listed])]


def _symbol() -> Column:
    symbol = F.lit(0)
    for i, n in enumerate(SIZES):
        symbol = symbol * n + F.col(f"f{i}")
    return symbol.cast("int").alias("symbol")


def _steps(turns: DataFrame, conv: str, turn: str, text: str, *more: Column) -> DataFrame:
    """Conversation (null is one of its own), turn number (null before all) and features of every row."""
    name = F.coalesce(F.concat(F.lit("c"), F.col(conv).cast("string")), F.lit("n"))
    rows = turns.select(name.alias("conv"), F.coalesce(F.col(turn).cast("long"), F.lit(-1)).alias("at"), *more, *features(text))
    return rows.withColumn("symbol", _symbol())


def train(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> Model:
    """Counts over all rows with a known role, smoothed by one (markers by their own prior); rows with another role are left out.

    A role follows the role of the turn numbered one less in its conversation, so a long conversation needs no window.
    """
    steps = _steps(turns, conv, turn, text, F.lower(F.trim(role)).alias("role")).filter(F.col("role").isin(*ROLES))
    seen = steps.groupBy("conv", "at", "role").agg(F.count("*").alias("n"))
    before = seen.select("conv", (F.col("at") + 1).alias("at"), F.col("role").alias("last")).distinct()
    pairs = seen.join(before, ["conv", "at"], "left").groupBy("last", "role", (F.col("at") <= 0).alias("opens")).agg(
        F.sum("n").alias("n")).collect()
    seen = [steps.groupBy("role", F.lit(i).alias("feature"), F.col(f"f{i}").alias("value")).count() for i in range(len(SIZES))]
    values = seen[0]
    for more in seen[1:]:
        values = values.unionAll(more)
    start = {r: 1 for r in ROLES}
    step = {(a, b): 1 for a in ROLES for b in ROLES}
    emit = {(r, i, v): 1 for r in ROLES for i, n in enumerate(SIZES) for v in range(n)}
    for a, r in enumerate(ROLES):
        for m in range(len(ROLES)):
            emit[r, 0, m + 1] = OWN_MARKER if a == m else OTHER_MARKER
    for p in pairs:
        if p["last"] is not None:
            step[p["last"], p["role"]] += p["n"]
        elif p["opens"]:
            start[p["role"]] += p["n"]
    for v in values.collect():  # roles times feature values
        emit[v["role"], v["feature"], v["value"]] += v["count"]

    def logs(counts):
        return tuple(math.log(c / sum(counts)) for c in counts)

    return Model(
        logs([start[r] for r in ROLES]), tuple(logs([step[a, b] for b in ROLES]) for a in ROLES),
        tuple(tuple(logs([emit[r, i, v] for v in range(n)]) for i, n in enumerate(SIZES)) for r in ROLES))


def _seen(model: Model, symbol: int) -> list[float]:
    values = []
    for n in reversed(SIZES):
        symbol, value = divmod(symbol, n)
        values.append(value)
    return [sum(own[i][v] for i, v in enumerate(reversed(values))) for own in model.emit]


def _best(model: Model, entry: list[float], symbols: list[int], last: int | None = None):
    """Scores at the end and, for the end role ``last`` (the best if None), the path. ``entry`` are scores before the first
    emission, by role."""
    roles = range(len(ROLES))
    score, back = [e + s for e, s in zip(entry, _seen(model, symbols[0]))], []
    for symbol in symbols[1:]:
        came = [max(roles, key=lambda i, j=j: score[i] + model.step[i][j]) for j in roles]
        seen = _seen(model, symbol)
        score = [score[came[j]] + model.step[came[j]][j] + seen[j] for j in roles]
        back.append(came)
    at = max(roles, key=score.__getitem__) if last is None else last
    path = [at]
    for came in reversed(back):
        path.append(came[path[-1]])
    return score, path[::-1]


def _entry(model: Model, role: int) -> list[float]:
    """Scores before the first emission of a segment; role -1 opens the conversation."""
    return list(model.start if role < 0 else model.step[role])


def roles(
    turns: DataFrame, model: Model, conv: str = "conv_id", turn: str = "turn", text: str = "text", segment: int = SEGMENT,
) -> DataFrame:
    """The most likely role of every distinct (conversation, turn number, features): ``conv``, ``at``, ``symbol``, ``role``.

    Rows that share a turn number are steps in the order of their features; equal ones are one step.
    """
    steps = _steps(turns, conv, turn, text).select("conv", "at", "symbol").distinct()
    part = F.floor(F.col("at") / segment).alias("part")
    parts = steps.groupBy("conv", part).agg(F.sort_array(F.collect_list(F.struct("at", "symbol"))).alias("steps"))

    def score(batches):
        for batch in batches:
            found = []
            for symbols in batch.column("symbols").to_pylist():
                found.append([s for role in range(-1, len(ROLES)) for s in _best(model, _entry(model, role), symbols)[0]])
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv"), batch.column("part"), pa.array(found, pa.list_(pa.float64()))], ["conv", "part", "scores"])

    def join(batches):
        n = len(ROLES)
        for batch in batches:
            out = []
            for conv_name, listed in zip(batch.column("conv").to_pylist(), batch.column("parts").to_pylist()):
                # Scores of a part by role before it (-1 opens) and role at its end; only the first part opens.
                total, back = [0.0], []
                for k, p in enumerate(listed):
                    rows = range(n + 1) if k else range(1)
                    table = [p["scores"][n * r : n * r + n] for r in rows][1 if k else 0 :]
                    came = [max(range(len(total)), key=lambda i, j=j: total[i] + table[i][j]) for j in range(n)]
                    total = [total[came[j]] + table[came[j]][j] for j in range(n)]
                    back.append(came)
                last = max(range(n), key=total.__getitem__)
                for k in range(len(listed) - 1, -1, -1):
                    before = back[k][last] if k else -1
                    out.append((conv_name, listed[k]["part"], before, last))
                    last = before
            yield pa.RecordBatch.from_arrays(
                [pa.array([o[i] for o in out], t) for i, t in enumerate((pa.string(), pa.int64(), pa.int32(), pa.int32()))],
                ["conv", "part", "before", "last"])

    def fill(batches):
        kind = pa.list_(pa.struct([("at", pa.int64()), ("symbol", pa.int32()), ("role", pa.string())]))
        for batch in batches:
            paths = []
            for listed, before, last in zip(*[batch.column(c).to_pylist() for c in ("steps", "before", "last")]):
                path = _best(model, _entry(model, before), [s["symbol"] for s in listed], last)[1]
                paths.append([{**s, "role": ROLES[r]} for s, r in zip(listed, path)])
            yield pa.RecordBatch.from_arrays([batch.column("conv"), pa.array(paths, kind)], ["conv", "steps"])

    symbols = F.transform("steps", lambda s: s["symbol"]).alias("symbols")
    scored = parts.select("conv", "part", symbols).mapInArrow(score, "conv string, part long, scores array<double>")
    # A line per SEGMENT turns of a conversation.
    chains = scored.groupBy("conv").agg(F.sort_array(F.collect_list(F.struct("part", "scores"))).alias("parts"))
    ends = chains.mapInArrow(join, "conv string, part long, before int, last int")
    filled = parts.join(ends, ["conv", "part"]).select("conv", "steps", "before", "last").mapInArrow(
        fill, "conv string, steps array<struct<at:long,symbol:int,role:string>>")
    return filled.select("conv", F.explode("steps").alias("s")).select("conv", "s.at", "s.symbol", "s.role")


def render(role: Column, text: Column) -> Column:
    """One turn: its role, its text without the speaker marker, and an end sign.

    Signs of the form itself in a text are escaped (``<|`` becomes ``<\\|``), so that no text makes a turn of its own.
    """
    content = F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), _any_marker(), ""))
    content = F.replace(content, F.lit("<|"), F.lit("<\\|"))
    return F.concat(F.lit("<|"), role, F.lit("|>\n"), content, F.lit("\n<|end|>"))


def format_chat(
    turns: DataFrame, model: Model, conv: str = "conv_id", turn: str = "turn", text: str = "text", segment: int = SEGMENT,
) -> DataFrame:
    """``conv_id``, ``turn``, ``role`` (recovered) and ``rendered`` for every row.

    Rows of a null conversation are one conversation; a null turn number comes before all. A null text is empty. Equal rows
    get equal roles. No rows give no rows. Other columns, a role column among them, are neither used nor carried.
    """
    rows = _steps(turns, conv, turn, text, F.col(conv).cast("long").alias("conv_id"),
                  F.col(turn).cast("long").alias("turn"), F.col(text).alias("text")).drop(*[f"f{i}" for i in range(len(SIZES))])
    found = roles(turns, model, conv, turn, text, segment)
    return rows.join(found, ["conv", "at", "symbol"]).select(
        "conv_id", "turn", "role", render(F.col("role"), F.col("text")).alias("rendered"))
