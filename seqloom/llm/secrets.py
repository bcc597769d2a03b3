"""Secrets in texts: key patterns, and sliding-window entropy over candidate strings."""

from __future__ import annotations

import math
import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed patterns of the base kinds, in the order in which kinds are listed.
ASSIGN = r"""((?i)password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"  # the longest match only grows to the right, so the bound may stand in the pattern
HEX = r"[0-9a-f]{24,}"
#: Shortest value of an assignment.
LEAST_VALUE = 6
#: Texts without these have no assignment.
ASSIGN_HINT = r"(?i)password|passwd|secret|token|api_?key"
WINDOW = 20
#: Entries of an array that are summed up one by one; longer ones are summed in parts of so many.
PART = 64
#: Characters of a text that are cut out together.
BLOCK = 1024
FOUND = "array<struct<start:int,no:int,end:int>>"


@dataclass(frozen=True)
class CharacterClass:
    """Runs of the class are candidates; a window of ``bits`` or more per character makes one a secret.

    A run has to hold a digit. With ``letters``, one of letters alone counts too if it mixes cases as drawn letters do and
    names do not: a third of its letters at least in either case, and at least as many changes of case.
    """

    kind: str
    characters: str
    bits: float
    letters: bool

    @property
    def pattern(self) -> str:
        # the lookahead is tried where a run begins: a run without any digit or second capital is a word
        hold = "(?:[0-9]|[A-Z][a-z]*[A-Z])" if self.letters else "[0-9]"
        return f"(?<![{self.characters}])(?=[{self.characters}]*?{hold})[{self.characters}]{{{WINDOW},}}"

    @property
    def alphabet(self) -> str:
        return "".join(c for c in map(chr, range(128)) if re.match(f"[{self.characters}]", c))


CLASSES = (
    CharacterClass("entropy_hex", "0-9A-Fa-f", 2.9, False),
    CharacterClass("entropy_base64", "A-Za-z0-9+/_=-", 3.8, True),
)
KINDS = ("assign", "access", "hex", *(c.kind for c in CLASSES))
#: Candidates that are no secrets: UUIDs, words joined by - _ / with short numbers, dates and times.
ALLOWED = (
    r"^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$",
    r"^[/_=-]*([A-Za-z]+|[0-9]{1,4})([/_=-]+([A-Za-z]+|[0-9]{1,4}))*[/_=-]*$",
    r"^[0-9/_=+-]+$",
)
#: Counted-up parts of a run; only windows outside them are judged.
COUNTED = r"(?i)(0123456789abcdef|abcdefghijklmnop)"
#: A change of case between two letters.
CASE_CHANGE = r"(?<=[a-z])[A-Z]|(?<=[A-Z])[a-z]"


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often it is used; an array of one element holds it."""
    return F.element_at(F.transform(F.array(value), use), 1)


def before(items: Column, combine: Callable[[Column, Column], Column]) -> Column:
    """For each entry of an array of numbers, those before it combined, from 0: as int, in time linear in the array.

    A list that grows by one entry is copied with each, so this is done in parts of ``PART``, and over the parts.
    """

    def scan(part: Column, start: Column) -> Column:
        def step(acc: Column, x: Column) -> Column:
            out = F.concat(acc["out"], F.array(acc["at"]))
            return F.struct(combine(acc["at"], x).cast("int").alias("at"), out.alias("out"))

        zero = F.struct(start.cast("int").alias("at"), F.array().cast("array<int>").alias("out"))
        return F.aggregate(part, zero, step)["out"]

    def of(items: Column) -> Column:
        starts = F.sequence(F.lit(1), F.size(items), F.lit(PART))
        parts = F.transform(starts, lambda i: F.slice(items, i, PART))

        def whole(parts: Column) -> Column:
            sums = F.transform(parts, lambda p: F.aggregate(p, F.lit(0), lambda a, x: combine(a, x).cast("int")))
            return F.flatten(F.zip_with(parts, scan(sums, F.lit(0)), scan))

        return F.when(F.size(items) > 0, bind(parts, whole)).otherwise(F.array().cast("array<int>"))

    return bind(items, of)


def _plus(a: Column, b: Column) -> Column:
    return a + b


def spans(text: Column, pattern: str, no: int, keep: Callable[[Column], Column] | None = None, group: int | None = None) -> Column:
    """Leftmost matches that do not overlap, as an array of ``(start, no, end)`` in code points.

    The text is split at the matches; a match starts after all pieces and matches before it. ``keep`` tells from
    a match, or from its ``group``, whether it counts; each is judged once.
    """
    none = F.array().cast(FOUND)

    def place(parts: Column) -> Column:
        moved = F.transform(parts, lambda p: p["piece"] + F.coalesce(F.length(p["hit"]), F.lit(0)))

        def one(p: Column, start: Column) -> Column:
            end = start + p["piece"] + F.length(p["hit"])
            kept = p["hit"].isNotNull() if keep is None else F.when(p["hit"].isNotNull(), keep(p["judged"])).otherwise(False)
            span = F.struct((start + p["piece"]).alias("start"), F.lit(no).alias("no"), end.alias("end"))
            return F.struct(span.alias("span"), kept.alias("kept"))

        placed = F.filter(F.zip_with(parts, before(moved, _plus), one), lambda x: x["kept"])
        return F.transform(placed, lambda x: x["span"])

    def found(hits: Column) -> Column:
        judged = hits if group is None else F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
        pieces = F.transform(F.split(text, pattern, -1), lambda p: F.length(p).cast("int"))
        parts = F.arrays_zip(pieces.alias("piece"), hits.alias("hit"), judged.alias("judged"))
        return F.when(F.size(hits) > 0, bind(parts, place)).otherwise(none)

    return bind(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), found)


def window_bits(candidate: Column, alphabet: str = "".join(map(chr, range(128))), window: int = WINDOW) -> Column:
    """The largest Shannon entropy, in bits per character, of any ``window`` characters of a string of the alphabet.

    Counts per character, five bits each in a few long numbers, are kept while the window slides: a step changes the counts of
    the character that enters and of the one that leaves, and with them the running sum of ``c log2 c`` (a whole number of
    2**-40 bits, so that nothing drifts). The entropy is ``log2 w - sum / w``, so the window with the smallest sum counts. A
    shorter string has entropy 0. The window is at most 31.
    """
    per = 12
    slots = {c: i for i, c in enumerate(alphabet)}
    n = -(-len(alphabet) // per)
    spots = ((i // per, 5 * (i % per)) for i in (slots.get(chr(c), 0) for c in range(128)))
    places = F.expr("array(" + ",".join(f"struct({w} AS word, {k} AS shift, {1 << k}L AS unit)" for w, k in spots) + ")")
    scale = float(2**40)
    weigh = F.expr("array(" + ",".join(f"{round(c * math.log2(c) * scale) if c else 0}L" for c in range(window + 2)) + ")")

    def weight(count: Column) -> Column:
        return F.get(weigh, count.cast("int"))

    def of(codes: Column) -> Column:
        zero = F.struct(
            F.array(*[F.lit(0).cast("long")] * n).alias("counts"),
            F.lit(0).cast("long").alias("total"),
            F.lit(2**62).cast("long").alias("least"),
        )

        def step(acc: Column, i: Column) -> Column:
            def held(x: Column) -> Column:
                return F.call_function("shiftright", F.get(acc["counts"], x["word"]), x["shift"]).bitwiseAND(31)

            into, out = F.get(codes, i), F.get(codes, i - window)
            more = held(into) - F.when(out.isNotNull() & (into == out), 1).otherwise(0)
            total = acc["total"] + weight(more + 1) - weight(more)
            total = total + F.when(out.isNotNull(), weight(held(out) - 1) - weight(held(out))).otherwise(0)
            counts = F.transform(
                acc["counts"],
                lambda c, j: c + F.when(j == into["word"], into["unit"]).otherwise(0) - F.when(j == out["word"], out["unit"]).otherwise(0),
            )
            least = F.when(i >= window - 1, F.least(acc["least"], total)).otherwise(acc["least"])
            return F.struct(counts.alias("counts"), total.alias("total"), least.alias("least"))

        least = F.aggregate(F.sequence(F.lit(0), F.size(codes) - 1), zero, step)["least"]
        return F.when(F.size(codes) < window, F.lit(0.0)).otherwise(F.lit(math.log2(window)) - least / (window * scale))

    codes = F.transform(F.filter(F.split(candidate, "", -1), lambda c: c != ""), lambda c: F.get(places, F.ascii(c)))
    return bind(codes, of)


def _is_secret(c: CharacterClass) -> Callable[[Column], Column]:
    def test(candidate: Column) -> Column:
        allowed = F.lit(False)
        for pattern in ALLOWED:
            allowed = allowed | F.regexp_like(candidate, F.lit(pattern))
        if c.letters:
            upper = F.regexp_count(candidate, F.lit("[A-Z]"))
            lower = F.regexp_count(candidate, F.lit("[a-z]"))
            changes = F.regexp_count(candidate, F.lit(CASE_CHANGE))
            mixed = 3 * F.least(upper, lower, changes) >= upper + lower
            allowed = F.when(F.regexp_like(candidate, F.lit("[0-9]")), allowed).otherwise(~mixed)
        pieces = F.filter(F.split(candidate, COUNTED, -1), lambda p: F.length(p) >= WINDOW)
        bits = F.transform(pieces, lambda p: window_bits(p, c.alphabet))
        return F.when(allowed, F.lit(False)).otherwise(F.exists(bits, lambda b: b >= c.bits))

    return test


def _of_kind(no: int) -> Callable[[Column], Column]:
    return lambda s: s["no"] == no


def scan(docs: DataFrame) -> DataFrame:
    """``docs`` with ``found``: all spans ``(start, no, end)`` by start, then kind; ``no`` counts in ``KINDS``.

    Base kinds are ``assign`` (a key word, a colon or equals sign and a value of six or more characters), ``access`` and
    ``hex``. The entropy kinds add runs of a character class that hold a digit (or mix the cases of letters), match no
    allow-list pattern and reach the class's entropy in some window outside counted-up parts. Spans are code points, end
    exclusive, over the whole text; spans of different kinds may overlap. A null text is empty and has no span, rows are
    scanned one by one (repeated rows alike), and all columns pass through. Everything is an expression on the row that holds
    the text: no shuffle, and work linear in the text and its matches.
    """
    def found(text: Column) -> Column:
        none = F.array().cast(FOUND)
        assign = spans(text, ASSIGN, 0, lambda value: F.length(value) >= LEAST_VALUE, 2)
        of_kind = [
            F.when(F.regexp_like(text, F.lit(ASSIGN_HINT)), assign).otherwise(none),
            F.when(F.contains(text, F.lit("AKIA")), spans(text, ACCESS, 1)).otherwise(none),
            spans(text, HEX, 2),
        ]
        of_kind += [spans(text, c.pattern, no, _is_secret(c)) for no, c in enumerate(CLASSES, start=3)]
        return F.array_sort(F.concat(*of_kind))

    return docs.withColumn("found", bind(F.coalesce("text", F.lit("")), found))


def listed(found: Column) -> Column:
    """Spans as ``kind:start:end``, comma-joined."""
    kinds = F.array(*(F.lit(k) for k in KINDS))
    return F.array_join(
        F.transform(found, lambda s: F.concat_ws(":", F.get(kinds, s["no"]), s["start"], s["end"])), ","
    )


def digest(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_assign, n_access, n_hex, base_sha256, spans)`` from ``scan``."""
    counts = [
        F.size(F.filter("found", _of_kind(no))).cast("long").alias(f"n_{KINDS[no]}") for no in range(3)
    ]
    base = F.filter("found", lambda s: s["no"] < 3)
    return docs.select("doc_id", *counts, F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("found")).alias("spans"))


def redact(docs: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """``docs`` (from ``scan``, without ``found``) with ``mark`` in place of each span; overlapping ones get one mark.

    Texts without a span stay as they are, null ones too. A text is cut at block borders first, so that taking a piece from its
    end does not walk through the whole.
    """

    def clear(blocks: Column, start: Column, end: Column) -> Column:
        first, last = F.floor(start / BLOCK).cast("int"), F.floor(end / BLOCK).cast("int")
        head = F.substring(F.get(blocks, first), start % BLOCK + 1, F.when(first == last, end - start).otherwise(BLOCK))
        tail = F.when(last > first, F.substring(F.get(blocks, last), F.lit(1), end % BLOCK))
        middle = F.when(last > first + 1, F.array_join(F.slice(blocks, first + 2, last - first - 1), ""))
        return F.concat(*(F.coalesce(x, F.lit("")) for x in (head, middle, tail)))

    def cut(blocks: Column) -> Column:
        ends = F.transform("found", lambda s: s["end"])

        def one(s: Column, at: Column) -> Column:
            return F.when(s["start"] >= at, F.concat(clear(blocks, at, s["start"]), F.lit(mark))).otherwise("")

        pieces = F.zip_with("found", before(ends, F.greatest), one)
        return F.concat(F.array_join(pieces, ""), clear(blocks, F.array_max(ends), F.length("text")))

    blocks = F.regexp_extract_all("text", F.lit(f"(?s).{{1,{BLOCK}}}"), F.lit(0))
    text = F.when(F.size("found") > 0, bind(blocks, cut)).otherwise(F.col("text"))
    return docs.withColumn("text", text).drop("found")
