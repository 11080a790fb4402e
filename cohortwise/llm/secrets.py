"""Secret scans with DataFrame functions only: patterns, and entropy of sliding windows.

``spans`` turns the matches of a pattern into places: the text split by the pattern, read in
turn with the matches, gives every start as a running sum of lengths. High-entropy strings are
found among token-like runs: a window of ``WINDOW`` characters slides over the run, counts per
character are updated for the one that enters and the one that leaves, and with them the sum
of c * log2(c) that gives the entropy. Every character class has its own threshold, and an
allow-list of harmless shapes suppresses what only looks random.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from cohortwise.llm.common import own_columns, quoted, unused

# The kinds in their order and their patterns.
KINDS = ("assign", "access", "hex", "entropy")
ASSIGN = (
    r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
#: Runs are maximal, so asking for the length in the pattern drops exactly the short ones.
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
LEAST_VALUE = 12

WINDOW = 20
#: A whole run of token characters that has a letter and a digit.
CANDIDATE = (
    r"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z+/_=-]*[0-9])(?=[0-9+/_=-]*[A-Za-z])"
    r"[A-Za-z0-9+/_=-]{20,}"
)
#: Bits that some window must reach, by the narrowest class that holds the whole run.
CLASSES = (
    (r"^[0-9a-fA-F]+$", 3.0),
    (r"^[0-9a-z]+$|^[0-9A-Z]+$", 3.6),
    (r"^[0-9A-Za-z]+$", 3.7),
    (r"", 3.8),
)
#: Harmless shapes: UUIDs, paths and hyphenated words that end in a number, dates, repeats.
ALLOWED = (
    r"^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$",
    r"^/?(?:[A-Za-z]+[/_-])++[A-Za-z]*[0-9]{0,4}$",
    r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[A-Za-z0-9-]*$",
    r"(?i)example|placeholder|changeme|dummy",
    r"^(.{1,4})\1+.{0,3}$",
)
SPAN = "struct<start:int,end:int,value:string>"
#: Stands in the place of a secret.
MARK = "<secret>"
#: Elements of an array that are gathered at a time, and code points of a block of text.
BLOCK = 256


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once; inside a lambda an outer value would be
    computed again for every element."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def scanned(
    items: Column, zero: Column, step: Callable[[Column, Column], tuple[Column, Column]], kind: str,
) -> Column:
    """What ``step(state, item)`` puts out beside the next state, for every item in turn.

    Appending copies an array, so outputs are gathered in blocks, and the blocks in a list.
    """
    def block(state: Column, part: Column) -> Column:
        def one(done: Column, item: Column) -> Column:
            after, out = step(done["s"], item)
            gathered = F.array_append(done["out"], out).cast(f"array<{kind}>")
            return F.struct(after.alias("s"), gathered.alias("out"))

        start = F.struct(state.alias("s"), F.array().cast(f"array<{kind}>").alias("out"))
        return F.aggregate(part, start, one)

    def every(all_: Column) -> Column:
        start = F.struct(zero.alias("s"), F.array().cast(f"array<array<{kind}>>").alias("out"))

        def more(done: Column, at: Column) -> Column:
            return let(block(done["s"], F.slice(all_, at, BLOCK)), lambda x: F.struct(
                x["s"].alias("s"),
                F.array_append(done["out"], x["out"]).cast(f"array<array<{kind}>>").alias("out"),
            ))

        blocks = F.sequence(F.lit(1), F.size(all_), F.lit(BLOCK))
        return F.when(F.size(all_) > 0, F.aggregate(blocks, start, more, lambda x: F.flatten(x["out"]))).otherwise(
            F.array().cast(f"array<{kind}>")
        )

    return let(items, every)


def spans(text: Column, pattern: str, group: int = 0) -> Column:
    """Start and end in code points of every match, and the string of its ``group``."""
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = hits if group == 0 else F.regexp_extract_all(text, F.lit(pattern), F.lit(group))

    def step(at: Column, item: Column) -> tuple[Column, Column]:
        begin = at + F.length(item["gap"])
        end = begin + F.coalesce(F.length(item["hit"]), F.lit(0))
        return end, F.struct(begin.alias("start"), end.alias("end"), item["value"].alias("value"))

    # The gap after the last match has none beside it.
    items = F.arrays_zip(F.split(text, pattern, -1), hits, values)
    found = scanned(
        items.cast("array<struct<gap:string,hit:string,value:string>>"), F.lit(0), step, SPAN
    )
    return F.filter(found, lambda s: s["value"].isNotNull())


def counted(c: Column) -> Column:
    """c * log2(c), zero for counts of zero and one."""
    return F.when(c <= 1, F.lit(0.0)).otherwise(c * F.log2(c))


def highest_entropy(value: Column, window: int = WINDOW) -> Column:
    """Highest Shannon entropy of any window of an ASCII string, in bits per character.

    The state is the count of each of the 128 characters and the sum of ``counted`` over them.
    """
    start = F.struct(
        F.array_repeat(F.lit(0), 128).alias("n"), F.lit(0.0).alias("s"), F.lit(0.0).alias("best")
    )

    def step(a: Column, x: Column) -> Column:
        enter, leave, i = x["enter"], x["leave"], x["i"]
        n_in, n_out = F.get(a["n"], enter), F.get(a["n"], leave)
        moved = a["s"] + F.when(enter == leave, F.lit(0.0)).otherwise(
            counted(n_in + 1) - counted(n_in)
            + F.when(leave < 0, F.lit(0.0)).otherwise(counted(n_out - 1) - counted(n_out))
        )
        counts = F.transform(a["n"], lambda x, k: (
            x + (k == enter).cast("int") - (k == leave).cast("int")
        ))
        best = F.when(i >= window - 1, F.greatest(a["best"], F.log2(F.lit(window)) - moved / window))
        return F.struct(
            counts.alias("n"), moved.alias("s"), best.otherwise(a["best"]).alias("best")
        )

    def slide(codes: Column) -> Column:
        # Each character beside the one that leaves the window as it enters; -1 for none.
        before = F.concat(F.array_repeat(F.lit(-1), window), codes)
        moves = F.arrays_zip(
            codes, F.slice(before, F.lit(1), F.size(codes)), F.sequence(F.lit(0), F.size(codes) - 1)
        )
        moves = moves.cast("array<struct<enter:int,leave:int,i:int>>")
        return F.aggregate(moves, start, step, lambda a: a["best"])

    return let(F.transform(F.split(value, ""), F.ascii), slide)


def suspicious(value: Column) -> Column:
    """Whether a candidate reaches the threshold of its class and has no harmless shape."""
    needed = F.lit(CLASSES[-1][1])
    for shape, bits in reversed(CLASSES[:-1]):
        needed = F.when(value.rlike(shape), F.lit(bits)).otherwise(needed)
    harmless = F.lit(False)
    for shape in ALLOWED:
        harmless = harmless | value.rlike(shape)
    return F.when(harmless, F.lit(False)).otherwise(highest_entropy(value) >= needed)


def named(found: Column, kind: str) -> Column:
    order = KINDS.index(kind)
    return F.transform(found, lambda s: F.struct(
        s["start"].alias("start"), F.lit(order).alias("order"), s["end"].alias("end"),
        F.lit(kind).alias("kind"),
    ))


def joined(found: Column) -> Column:
    """kind:start:end by start, then kind, joined by commas."""
    return F.array_join(F.transform(F.array_sort(found), lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string")
    )), ",")


def found_in(text: Column) -> Column:
    """Spans of a text as (start, order, end, kind)."""
    body = F.coalesce(text, F.lit(""))
    assigned = F.filter(spans(body, ASSIGN, 1), lambda s: F.length(s["value"]) >= LEAST_VALUE)
    runs = F.filter(spans(body, CANDIDATE), lambda s: suspicious(s["value"]))
    return F.concat(
        named(assigned, "assign"), named(spans(body, ACCESS), "access"), named(spans(body, HEX), "hex"),
        named(runs, "entropy"),
    )


def find_secrets(docs: DataFrame, text: str = "text", into: str = "found") -> DataFrame:
    """All columns of ``docs`` and ``into``, an array of its spans (start, order, end, kind).

    Null text is the empty text and has no spans. Ties in start are ordered by kind. Works row
    by row, so repeated rows, empty tables, null ids and any other column pass through; only
    ``into`` must not be the name of a column, else ValueError.
    """
    if into.lower() in {c.lower() for c in docs.columns}:
        raise ValueError(f"a column is named {into}")
    return docs.select(*own_columns(docs), found_in(F.col(quoted(text))).alias(into))


def report(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: doc_id, counts of the base kinds, base_sha256, spans and n_entropy."""
    found = docs.select(F.col(quoted(doc_id)).alias("doc_id"), found_in(F.col(quoted(text))).alias("found"))
    count = lambda kind: F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long")
    base = F.filter("found", lambda s: s["kind"] != "entropy")
    return found.select(
        "doc_id", *[count(kind).alias(f"n_{kind}") for kind in KINDS],
        F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("found")).alias("spans"),
    )


def blanked(text: Column, found: Column, mark: str) -> Column:
    """A text with spans replaced. Ranges are read from blocks of the text: a range of the
    text itself would be counted from its start every time."""
    def between(blocks: Column, start: Column, end: Column) -> Column:
        first, last = F.floor(start / BLOCK).cast("int"), F.floor((end - 1) / BLOCK).cast("int")
        parts = F.transform(F.sequence(first, last), lambda i: F.substring(
            F.get(blocks, i), F.greatest(start - i * BLOCK, F.lit(0)) + 1,
            end - F.greatest(start, i * BLOCK),
        ))
        return F.when(end > start, F.array_join(parts, "")).otherwise(F.lit(""))

    def cleaned(blocks: Column) -> Column:
        def step(at: Column, s: Column) -> tuple[Column, Column]:
            fresh = (s["start"] > at) | (at == 0)
            piece = F.concat(between(blocks, at, s["start"]), F.lit(mark))
            return F.greatest(at, s["end"]), F.when((s["start"] >= at) & fresh, piece).otherwise("")

        rest = between(blocks, F.array_max(F.transform(found, lambda s: s["end"])), F.length(text))
        return F.concat(F.array_join(scanned(F.array_sort(found), F.lit(0), step, "string"), ""), rest)

    blocks = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{BLOCK}}}"), F.lit(0))
    return F.when(F.size(found) > 0, let(blocks, cleaned)).otherwise(text)


def redact(docs: DataFrame, text: str = "text", mark: str = MARK) -> DataFrame:
    """Every span replaced by ``mark``, overlapping and touching spans by one; clean rows and
    all other columns, whatever their names, are untouched."""
    found = unused(docs, "found")
    marked = find_secrets(docs, text, found)
    clean = blanked(F.col(quoted(text)), F.col(found), mark)
    return marked.select(*[
        clean.alias(c) if c == text else F.col(quoted(c)) for c in docs.columns
    ])
