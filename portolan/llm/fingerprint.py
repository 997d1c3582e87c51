"""I-Match document fingerprints, in DataFrame operations only.

Terms within a band of document frequency make up the lexicon. A text's distinct
lexicon terms are sorted and hashed once for each of several randomised subsets
of the lexicon; the hashes together are its fingerprint. The likeness of two
fingerprints is the share of subsets, among those in which either text has a
term, whose hashes agree.

Terms are told apart by a hash into ``SLOTS`` places, so the lexicon is a bit map
of fixed size whatever the vocabulary is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from portolan.llm.tables import ROW, numbered, pieces, stored, text_bytes
from portolan.sinks import Staging

SLOT_BITS = 20
SLOTS = 1 << SLOT_BITS
# Terms in more than HIGH or fewer than LOW of the documents tell too little or occur by chance.
LOW, HIGH = 0.001, 0.05
SUBSETS = 64
# Hexadecimal digits of each subset's hash.
DIGITS = 6
# Text of a range of documents, and how many ranges there are at most: larger tables have larger ones.
RANGE_BYTES, MAX_RANGES = 8 << 20, 1 << 16
# ASCII characters that are neither letters nor digits part terms; other characters belong to them.
PARTING = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def term_slots(text: Column) -> Column:
    """Distinct slots of a text's lower-case terms."""
    terms = F.filter(F.split(F.lower(text), PARTING), lambda t: t != "")
    return F.array_distinct(F.transform(terms, lambda t: F.pmod(F.xxhash64(t), F.lit(SLOTS))))


def lexicon(docs: DataFrame, staging: Staging, low: float = LOW, high: float = HIGH) -> DataFrame:
    """One row, ``bits``: a bit per slot, set if between ``low`` and ``high`` of all rows have a term there."""
    slots = docs.select(F.explode(term_slots(F.col("text"))).alias("slot"))
    counts = slots.groupBy("slot").agg(F.count(F.lit(1)).alias("n"))
    # One number, fetched to compare counts with.
    total = docs.count()
    band = counts.where((F.col("n") >= max(2.0, low * total)) & (F.col("n") <= max(2.0, high * total)))
    words = band.groupBy(F.shiftright("slot", 6).alias("word")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("slot").bitwiseAND(F.lit(63)).cast("int"))).alias("bits")
    )
    # SLOTS / 64 rows, all of them, in order.
    every = docs.sparkSession.range(SLOTS >> 6).withColumnRenamed("id", "word").join(words, "word", "left")
    row = every.agg(F.sort_array(F.collect_list(F.struct("word", F.coalesce("bits", F.lit(0)).alias("bits")))).alias("all"))
    return staging.write(row.select(F.col("all.bits").alias("bits")), "lexicon")


def _once(value: Column, then) -> Column:
    """``then(value)`` with ``value`` computed once: lambdas would compute an expression once per element."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def fingerprint(text: Column, bits: Column) -> Column:
    """Subset hashes of a text, parted by ``-``; a subset without a term of the text is empty.

    A text without any lexicon term is taken by all of its terms.
    """

    def known(slot: Column) -> Column:
        bit = F.call_function("shiftleft", F.lit(1).cast("long"), slot.bitwiseAND(F.lit(63)).cast("int"))
        return F.get(bits, F.shiftright(slot, 6).cast("int")).bitwiseAND(bit) != 0

    def used(slots: Column) -> Column:
        return _once(F.filter(slots, known), lambda inside: F.when(F.size(inside) > 0, inside).otherwise(slots))

    # Each term carries its subset, a random one of the SUBSETS, in front, and each subset begins
    # with a mark that is smaller than its terms. So one sort of numbers puts every subset's terms together, in order.
    one = 1 << SLOT_BITS
    marks = F.sequence(F.lit(0).cast("long"), F.lit(SUBSETS * 2 * one).cast("long"), F.lit(2 * one).cast("long"))
    subset = lambda s: F.pmod(F.xxhash64(s, F.lit(11)), F.lit(SUBSETS))
    dealt = lambda slots: F.sort_array(F.concat(F.transform(slots, lambda s: subset(s) * F.lit(2 * one) + F.lit(one) + s), marks))

    def hashes(terms: Column) -> Column:
        def at(places: Column) -> Column:
            every = F.sequence(F.lit(0), F.lit(SUBSETS - 1))
            cut = lambda k: F.slice(terms, F.get(places, k) + 1, F.get(places, k + 1) - F.get(places, k) - 1)
            return F.array_join(F.transform(every, lambda k: _hash(F.transform(cut(k), lambda v: v.bitwiseAND(F.lit(one - 1))))), "-")

        return _once(F.transform(marks, lambda m: F.array_position(terms, m).cast("int")), at)

    return _once(_once(_once(term_slots(text), used), dealt), hashes)


def _hash(terms: Column) -> Column:
    return _once(terms, lambda x: F.when(F.size(x) == 0, "").otherwise(F.right(F.hex(F.xxhash64(x)), F.lit(DIGITS))))


def likeness(one: Column, other: Column) -> Column:
    """Share of agreeing subsets among those in which either fingerprint has a term; 1 if none has one."""
    pairs = F.arrays_zip(F.split(one, "-").alias("a"), F.split(other, "-").alias("b"))
    either = F.size(F.filter(pairs, lambda p: (p["a"] != "") | (p["b"] != "")))
    both = F.size(F.filter(pairs, lambda p: (p["a"] == p["b"]) & (p["a"] != "")))
    return F.when(either == 0, F.lit(1.0)).otherwise(both / either)


def next_texts(docs: DataFrame, order: list[str], bits: Column, staging: Staging) -> DataFrame:
    """Add ``fp``, the text's fingerprint, and ``next``: the (text, fp) of the row that follows in ascending order, the first one's for the last row.

    Rows are dealt out by ranges of ``order``, which ends with the row's number, so
    that rows of one id, or without any, are cut like others; only the first row of
    each range is looked up from outside it. Where ranges begin is one array of at
    most ``MAX_RANGES`` keys, searched by bisection; the plan is the same for any number of them.
    """
    ranges = min(pieces(text_bytes(docs, "text"), RANGE_BYTES), MAX_RANGES)
    # Nulls first, in a form in which nothing is null.
    parts = [x for c in order for x in (F.col(c).isNotNull(), F.coalesce(F.col(c), F.lit(0).cast("long")))]
    docs = docs.withColumn("at", F.struct(*[x.alias(f"k{i}") for i, x in enumerate(parts)]))
    limits = range_limits(docs.select("at"), ranges, staging)
    docs = docs.withColumn("limits", limits.select("limits").scalar())
    docs = docs.withColumn("range", _place(F.col("at"), F.col("limits"), ranges)).drop("at", "limits")
    own = F.struct("text", "fp")
    window = Window.partitionBy("range").orderBy(*order)
    dealt = docs.withColumn("bits", bits).withColumn("fp", fingerprint(F.col("text"), F.col("bits"))).drop("bits")
    # Column by column: a struct of both would be made, text and all, before the shuffle.
    dealt = dealt.withColumns({c: F.lead(of).over(window) for c, of in (("after", "text"), ("after_fp", "fp"))})
    # A range begins with the row that its limit names; this row follows the last one of the range before.
    heads = limits.select(F.size("limits").alias("n"), F.posexplode("limits").alias("place", "at"))
    heads = heads.select(F.pmod(F.col("place") - 1, F.col("n")).alias("range"), F.col(f"at.k{2 * len(order) - 1}").alias(order[-1]))
    # At most MAX_RANGES pairs of numbers.
    first = docs.drop("range").join(F.broadcast(heads), order[-1]).withColumn("bits", bits)
    first = first.withColumn("fp", fingerprint(F.col("text"), F.col("bits"))).select("range", own.alias("beyond"))
    following = F.when(F.col("after").isNotNull(), F.struct(F.col("after").alias("text"), F.col("after_fp").alias("fp")))
    return dealt.join(first, "range", "left").withColumn("next", F.coalesce(following, "beyond")).drop("after", "after_fp", "beyond")


def range_limits(keys: DataFrame, ranges: int, staging: Staging) -> DataFrame:
    """One row, ``limits``: the first key of each of about ``ranges`` even ranges of the struct ``at``, in ascending order."""
    dealt = keys.repartitionByRange(ranges, "at").groupBy(F.spark_partition_id().alias("part")).agg(F.min("at").alias("at"))
    return staging.write(dealt.agg(F.sort_array(F.collect_list("at")).alias("limits")), "limits")


def _place(value: Column, limits: Column, most: int) -> Column:
    """Place of the last limit that is at most ``value``; there are up to ``most`` limits."""

    def halve(span: Column, _: Column) -> Column:
        middle = F.shiftright(span["low"] + span["high"], 1)
        up = F.get(limits, middle) <= value  # null once low and high have met at the end
        found = (span["low"] < span["high"]) & F.coalesce(up, F.lit(False))
        return F.struct(
            F.when(found, middle + 1).otherwise(span["low"]).alias("low"), F.when(found, span["high"]).otherwise(middle).alias("high")
        )

    whole = F.struct(F.lit(0).alias("low"), F.size(limits).alias("high"))
    steps = F.sequence(F.lit(0), F.lit(most.bit_length()))
    return F.aggregate(steps, whole, halve, lambda span: F.greatest(span["low"] - 1, F.lit(0)))


def with_edits(docs: DataFrame, staging: Staging, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of ``docs``: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The edited text is the text with its last ``floor(n_chars / 2)`` characters
    replaced by the first as many (or all) of the next document by ascending
    ``doc_id``; the first follows the last. A null text counts as empty; a null
    id comes first, equal ids go by their texts' hashes.
    """
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    docs = numbered(stored(docs, staging))
    lex = lexicon(docs, staging)
    bits = lex.select("bits").scalar()
    docs = docs.withColumn("tie", F.xxhash64("text"))
    whole = next_texts(docs, ["doc_id", "tie", ROW], bits, staging)
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), n - half), F.substring(F.col("next.text"), F.lit(1), half))
    whole = whole.select("doc_id", n.cast("long").alias("n_chars"), "fp", F.col("next.fp").alias("next_fp"), edited.alias("edited"))
    whole = whole.withColumn("bits", bits)
    whole = whole.withColumn("edited_fp", fingerprint(F.col("edited"), F.col("bits")))
    return whole.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        F.col("fp").alias("fingerprint"),
        F.col("edited_fp").alias("edited_fingerprint"),
        likeness(F.col("fp"), F.col("edited_fp")).alias("near_edited"),
        likeness(F.col("fp"), F.col("next_fp")).alias("near_next"),
    )
