"""Secret scans with DataFrame functions only: known patterns, and windows of high entropy.

Base kinds are regular expressions, leftmost and without overlap. Further spans (kind
``entropy``) come from candidate strings: a window of fixed length slides over each candidate,
with the counts of its characters updated by the one that enters and the one that leaves, and
with them the sum of c * log2(c). The Shannon entropy of the window is log2(w) minus that sum
over w. Each character class (hex, alphanumeric, base64) has its own limit. Windows beyond it
are merged; spans that lie inside a base span are left out.

A window that holds an example value is not high. Of whole candidates, UUIDs, paths made of words and
UUIDs, and strings without a digit or without a letter are cleared. ``redact`` removes the whole candidate that
holds a high window.

Positions are code points. Places come from the lengths of matches and of the text between them;
they are added up in blocks, so that many matches in one text don't cost their square.

Nulls and empty texts have no spans. Rows are independent of each other, so repeated ones have the same spans.
A candidate is read once from end to end whatever its length, and so is a text of one long candidate. Spans
that start together are listed in the order of their kinds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.llm.common import free_names

# Fixed values of the contract.
ASSIGN = (
    r"(?i:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
# A shorter run fails as a whole, so the least length may stand in the pattern.
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"(?<![0-9a-f])[0-9a-f]{24,}"
ASSIGN_LEAST = 6
KINDS = ("assign", "access", "hex")

WINDOW = 20
CANDIDATE = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{%d,}"
ALPHABET = "0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ+/_=-"
# Class of a candidate, by the first pattern that fits, and least entropy of a window in bits.
CLASSES = (("hex", "^[0-9a-fA-F]+$", 3.0), ("alnum", "^[0-9A-Za-z]+$", 3.6), ("base64", "", 3.8))
# Example values, which clear the windows that hold them, as words in either case or as a run of one character.
EXAMPLES = "example|sample|dummy|placeholder|changeme|test|0123456789|abcdefgh"
RUN = 8
# Segments of a path that is cleared: UUIDs, or words of one case with a short number.
UUID = "^[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$"
PATH_WORD = "^(?:[A-Z]?[a-z]{1,20}|[A-Z]{1,20})?[0-9]{0,4}$"
BLOCK = 500


def bound(value: Column, then) -> Column:
    """then(value) with the value computed once, however often it is used there."""
    return F.element_at(F.transform(F.array(value), then), 1)


MATCHES = "array<struct<start:int,end:int,match:string>>"


def located(text: Column, pattern: str) -> Column:
    """Matches as array<struct<start, end, match>>, in code points."""
    quoted = F.lit(pattern)

    def parts(matches: Column) -> Column:
        return F.zip_with(
            F.slice(F.split(text, pattern, -1), 1, F.size(matches)),
            matches,
            lambda piece, match: F.struct(F.char_length(piece).alias("gap"), match.alias("match")),
        )

    def blocks(parts: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(0), F.floor((F.size(parts) - 1) / BLOCK).cast("int")),
            lambda i: _placed(F.slice(parts, i * BLOCK + 1, F.lit(BLOCK))),
        )

    def joined(blocks: Column) -> Column:
        begins = F.aggregate(
            blocks,
            F.array(F.lit(0)),
            lambda sums, block: F.concat(sums, F.array(F.element_at(sums, -1) + block["at"])),
        )
        return F.flatten(F.zip_with(blocks, F.slice(begins, 1, F.size(blocks)), _shifted))

    found = bound(bound(bound(F.regexp_extract_all(text, quoted, F.lit(0)), parts), blocks), joined)
    return F.when(text.rlike(pattern), found).otherwise(F.array().cast(MATCHES))


def _shifted(block: Column, begin: Column) -> Column:
    return F.transform(
        block["found"],
        lambda x: F.struct(
            (x["start"] + begin).alias("start"), (x["end"] + begin).alias("end"), x["match"].alias("match")
        ),
    )


def _placed(parts: Column) -> Column:
    return F.aggregate(
        parts,
        F.struct(F.lit(0).alias("at"), F.array().cast(MATCHES).alias("found")),
        lambda s, x: F.struct(
            (s["at"] + x["gap"] + F.char_length(x["match"])).alias("at"),
            F.concat(
                s["found"],
                F.array(
                    F.struct(
                        (s["at"] + x["gap"]).alias("start"),
                        (s["at"] + x["gap"] + F.char_length(x["match"])).alias("end"),
                        x["match"].alias("match"),
                    )
                ),
            ).alias("found"),
        ),
    )


def base_spans(text: Column) -> Column:
    """Spans of the base kinds as array<struct<start, order, kind, end>>, sorted."""
    found = []
    for order, (kind, pattern) in enumerate(zip(KINDS, (ASSIGN, ACCESS, HEX))):
        matches = located(text, pattern)
        if kind == "assign":
            matches = F.filter(
                matches,
                lambda m: F.char_length(F.regexp_extract(m["match"], ASSIGN, 2)) >= ASSIGN_LEAST,
            )
        found.append(_spans(matches, order, kind))
    return F.array_sort(F.concat(*found))


def _spans(matches: Column, order: int, kind: str) -> Column:
    return F.transform(matches, lambda m: _span(m["start"], order, kind, m["end"]))


def _span(start: Column, order: int, kind: str, end: Column) -> Column:
    return F.struct(
        start.alias("start"), F.lit(order).alias("order"), F.lit(kind).alias("kind"), end.alias("end")
    )


def _weight(count: Column) -> Column:
    """c * log2(c), and 0 for 0."""
    return F.when(count > 1, count * F.log2(count.cast("double"))).otherwise(F.lit(0.0))


def _harmless(candidate: Column) -> Column:
    """Whether all of a candidate is a UUID or a path of words and UUIDs."""

    def plain(segment: Column) -> Column:
        words = F.forall(F.split(segment, "[_-]"), lambda word: word.rlike(PATH_WORD))
        return segment.rlike(UUID) | words

    path = candidate.contains("/") & F.forall(F.split(candidate, "/"), plain)
    return candidate.rlike(UUID) | path


def entropy_spans(candidate: Column, window: int = WINDOW) -> Column:
    """Merged windows of high entropy in one candidate as array<struct<start, end>>."""
    limit = F.lit(CLASSES[-1][2])
    for _, pattern, least in reversed(CLASSES[:-1]):
        limit = F.when(candidate.rlike(pattern), F.lit(least)).otherwise(limit)
    span = "struct<start:int,end:int>"

    def step(s: Column, character: Column) -> Column:
        # The character that leaves goes first; the counts it changes are those the next one sees.
        first = F.when(s["at"] >= window, F.substring(s["recent"], 1, 1)).otherwise(F.lit(""))
        codes = F.struct(_code(character).alias("enters"), _code(first).alias("leaves"))
        return bound(codes, lambda c: _slide(s, character, c["enters"], c["leaves"], window, limit))

    start = F.struct(
        F.lit(0).alias("at"),
        F.lit("").alias("recent"),
        F.array_repeat(F.lit(0), len(ALPHABET)).alias("counts"),
        F.lit(0.0).alias("total"),
        F.lit(None).cast(span).alias("open"),
        F.array().cast(f"array<{span}>").alias("done"),
    )
    found = F.aggregate(
        F.split(candidate, ""),
        start,
        step,
        lambda s: F.when(s["open"].isNull(), s["done"]).otherwise(F.concat(s["done"], F.array(s["open"]))),
    )
    plain = ~candidate.rlike("[0-9]") | ~candidate.rlike("[A-Za-z]") | _harmless(candidate)
    return F.when(plain, F.array().cast(f"array<{span}>")).otherwise(found)


def _code(character: Column) -> Column:
    """Place in the alphabet from 1, and 0 for no character."""
    return F.when(character == "", 0).otherwise(F.position(character, F.lit(ALPHABET)))


def _slide(s: Column, character: Column, enters: Column, leaves: Column, window: int, limit: Column) -> Column:
    """The state of the window one character further on."""
    at = s["at"] + 1
    full = leaves > 0
    recent = F.concat(F.when(full, F.substring(s["recent"], 2, window)).otherwise(s["recent"]), character)
    before = F.when(full, F.element_at(s["counts"], F.greatest(leaves, F.lit(1)))).otherwise(F.lit(0))
    count = F.element_at(s["counts"], enters) - F.when(leaves == enters, 1).otherwise(0)
    total = (
        s["total"]
        - F.when(full, _weight(before) - _weight(before - 1)).otherwise(F.lit(0.0))
        + _weight(count + 1)
        - _weight(count)
    )
    counts = F.when(leaves == enters, s["counts"]).otherwise(
        F.transform(
            s["counts"],
            lambda c, k: F.when(k == leaves - 1, c - 1).when(k == enters - 1, c + 1).otherwise(c),
        )
    )

    def moved(now: Column) -> Column:
        joins = s["open"].isNotNull() & (at - window <= s["open"]["end"])
        begin = F.when(joins, s["open"]["start"]).otherwise(at - window)
        return F.struct(
            at.alias("at"),
            now["recent"].alias("recent"),
            counts.alias("counts"),
            now["total"].alias("total"),
            F.when(now["high"], F.struct(begin.alias("start"), at.alias("end"))).otherwise(s["open"]).alias("open"),
            F.when(now["high"] & s["open"].isNotNull() & ~joins, F.concat(s["done"], F.array(s["open"])))
            .otherwise(s["done"])
            .alias("done"),
        )

    def judged(now: Column) -> Column:
        entropy = F.log2(F.lit(float(window))) - now["total"] / window
        example = now["recent"].rlike(f"(?i:{EXAMPLES})|(.)\\1{{{RUN - 1}}}")
        high = F.when((at >= window) & (entropy >= limit), ~example).otherwise(F.lit(False))
        return bound(F.struct(now["recent"].alias("recent"), now["total"].alias("total"), high.alias("high")), moved)

    return bound(F.struct(recent.alias("recent"), total.alias("total")), judged)


def scan(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """All columns of the documents, and base and spans: array<struct<start, order, kind, end>>.

    base holds the spans of the known kinds, spans these and those of high entropy, both sorted by
    start and kind. Columns of these names are replaced.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return _scan(docs.drop("base", "spans"), text, window, lambda c: entropy_spans(c, window), "base", "spans")


def _whole(candidate: Column) -> Column:
    """All of a candidate that holds a window of high entropy, as array<struct<start, end>>."""
    span = F.struct(F.lit(0).alias("start"), F.char_length(candidate).alias("end"))
    return F.transform(F.slice(entropy_spans(candidate, WINDOW), 1, 1), lambda _: span)


def _scan(docs: DataFrame, text: Column, window: int, of_candidate, base: str, spans: str) -> DataFrame:
    (seen,) = free_names([*docs.columns, base, spans], "seen")
    # Both as columns of their own, so that they are computed once.
    found = docs.withColumns({base: base_spans(text), seen: located(text, CANDIDATE % window)})
    high = F.flatten(
        F.transform(
            F.col(seen),
            lambda c: F.transform(
                of_candidate(c["match"]),
                lambda s: _span(c["start"] + s["start"], len(KINDS), "entropy", c["start"] + s["end"]),
            ),
        )
    )
    added = F.filter(
        high,
        lambda s: ~F.exists(F.col(base), lambda b: (b["start"] <= s["start"]) & (s["end"] <= b["end"])),
    )
    return found.withColumn(spans, F.array_sort(F.concat(base, added))).drop(seen)


def listed(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )


def redact(docs: DataFrame, mark: str = "[secret]") -> DataFrame:
    """The documents with each found span (merged where they overlap) replaced by the mark.

    Of a candidate with a window of high entropy no character stays. No column but text changes.
    """
    base, spans, gaps = free_names(docs.columns, "base", "spans", "gaps")
    merged = F.aggregate(
        F.col(spans),
        F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("gaps")),
        lambda s, x: F.struct(
            F.greatest(s["at"], x["end"]).alias("at"),
            F.when(
                x["start"] >= s["at"],
                F.concat(s["gaps"], F.array(F.struct(s["at"].alias("start"), x["start"].alias("end")))),
            )
            .otherwise(s["gaps"])
            .alias("gaps"),
        ),
    )
    text = F.col("text")
    pieces = F.transform(
        F.col(gaps)["gaps"], lambda g: F.substring(text, g["start"] + 1, g["end"] - g["start"])
    )
    rest = F.substring(text, F.col(gaps)["at"] + 1, F.char_length(text))
    clean = F.concat(F.array_join(pieces, mark), F.lit(mark), rest)
    return (
        _scan(docs, F.coalesce(F.col("text").cast("string"), F.lit("")), WINDOW, _whole, base, spans)
        .withColumn(gaps, F.when(F.size(spans) > 0, merged))
        .withColumn("text", F.when(F.col(gaps).isNull(), text).otherwise(clean))
        .drop(base, spans, gaps)
    )
