"""I-Match document fingerprints over a band of inverse document frequency.

A term is a lower-cased word, stood for by its 64-bit hash. Document
frequencies are counted over all documents. The lexicon holds the terms whose
share of documents lies between ``low`` and ``high`` (a band of idf =
ln(documents / df) from ln(1 / high) to ln(1 / low)). A document has d distinct
terms on average, so at most d / low terms can be in the lexicon, whatever the
number of documents. A lexicon of up to ``LEXICON`` terms travels with the plan
as one constant, a hash table of arrays, so fingerprinting needs no shuffle; a
larger one stays a table that the documents' terms are joined with.

A fingerprint is the hash of a text's sorted distinct lexicon terms, followed
by the same hash under random subsets of the lexicon: for each (bits, n) of
``SUBSETS``, n of them with one term in ``1 << bits`` each, drawn by the term's
hash. Large subsets tell short texts apart, small ones leave something
untouched in long texts. ``likeness`` of two fingerprints is 1 if they are
equal, else the share of equal hashes among the subsets that either text has
terms of (0 if none).

The edited texts look one document ahead. The rows' order is found on ids and
hashes alone, by a range exchange that gives the borders of parts; then the
rows are dealt by part, each text once, with the first row of the following
part as a guest, and a window inside the part reads the next text.

Edge cases: a null text counts as empty. A text without lexicon terms is
fingerprinted by all its distinct terms and has no subset hash. Rows that repeat
an id come in the order of their texts' hashes, rows that repeat id and text one
after the other. ``docs`` is read more than once and must be a table or a frame
that gives the same rows in the same partitions again. Only the id and the text
are read.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kitwise.llm.scratch import Scratch

#: (bits, n): n subsets with one term in 2**bits each.
SUBSETS = ((6, 32), (10, 32))
#: Slots of the lexicon's hash table; terms that it may have.
SLOTS, LEXICON = 1 << 14, 1 << 18
#: Parts of the order for each shuffle partition.
PARTS = 4
#: What stands for a subset without terms.
NONE = "-"


def terms(text: Column) -> Column:
    """Distinct term hashes of a text."""
    words = F.split(F.lower(F.coalesce(text, F.lit(""))), r"[\x20\x09-\x0D]+")
    return F.array_distinct(F.transform(F.filter(words, lambda w: w != ""), lambda w: F.xxhash64(w)))


@dataclass
class Lexicon:
    """``slots``: the constant, or None where the terms are many; ``band``: the terms as a table."""

    slots: Column | None
    band: DataFrame


def lexicon(docs: DataFrame, text_col: str, low: float, high: float, scratch: Scratch) -> Lexicon:
    n = docs.count()
    df = docs.select(F.explode(terms(F.col(text_col))).alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    band = scratch.save(df.where((F.col("df") >= low * n) & (F.col("df") <= high * n)).select("term"), "lexicon")
    if band.count() > LEXICON:
        return Lexicon(None, band)
    slots: list[list[int]] = [[] for _ in range(SLOTS)]
    for (term,) in band.orderBy("term").collect():
        slots[term % SLOTS].append(term)
    return Lexicon(F.from_json(F.lit(json.dumps(slots, separators=(",", ":"))), "array<array<bigint>>"), band)


def _place(term: Column, used: int, bits: int) -> Column:
    """The ``bits`` bits of a term's hash after the first ``used``."""
    return F.shiftrightunsigned(F.shiftleft(term, used), 64 - bits)


def _drawn(used: int, bits: int, n: int):
    return lambda t: _place(t, used, bits) < F.lit(n)


def _subsets(few: Column, used: int, bits: int, n: int) -> Column:
    numbers = F.sequence(F.lit(0), F.lit(n - 1))
    return F.transform(numbers, lambda i: F.filter(few, lambda t: _place(t, used, bits) == i))


def with_fingerprint(df: DataFrame, text_col: str, out_col: str, lex: Lexicon) -> DataFrame:
    """``df`` with the fingerprint string of ``text_col``: <all terms>:<subset>:<subset>...

    Each step is a column of its own, as the next one uses it many times.
    """
    own, kept, drawn, subsets, row = (f"__{out_col}_{x}" for x in ("own", "kept", "drawn", "subsets", "row"))
    df = df.withColumn(own, terms(F.col(text_col)))
    if lex.slots is not None:
        slots = lex.slots
        found = F.filter(F.col(own), lambda t: F.array_contains(F.get(slots, F.pmod(t, F.lit(SLOTS)).cast("int")), t))
        df = df.withColumn(kept, F.sort_array(found))
    else:
        df = Scratch(df.sparkSession).save(df.withColumn(row, F.monotonically_increasing_id()), "rows")
        hits = df.select(row, F.explode(own).alias("term")).join(lex.band, "term", "left_semi")
        hits = hits.groupBy(F.col(row).alias("at")).agg(F.sort_array(F.collect_list("term")).alias(kept))
        df = df.join(hits, df[row] == hits["at"], "left").drop(row, "at").withColumn(kept, F.coalesce(kept, F.array().cast("array<bigint>")))
    hashes, used = [], 0
    for k, (bits, n) in enumerate(SUBSETS):
        few, sets = f"{drawn}_{k}", f"{subsets}_{k}"
        df = df.withColumn(few, F.filter(F.col(kept), _drawn(used, bits, n))).withColumn(sets, _subsets(F.col(few), used, bits, n))
        hashes.append(F.transform(F.col(sets), lambda c: F.when(F.size(c) > 0, F.substring(F.hex(F.xxhash64(c)), -6, 6)).otherwise(F.lit(NONE))))
        used += bits
    main = F.lpad(F.hex(F.xxhash64(F.when(F.size(kept) > 0, F.col(kept)).otherwise(F.sort_array(own)))), 16, "0")
    df = df.withColumn(out_col, F.concat_ws(":", main, *hashes))
    return df.drop(own, kept, *[f"{c}_{k}" for c in (drawn, subsets) for k in range(len(SUBSETS))])


def likeness(one: Column, other: Column) -> Column:
    """0 to 1; equal fingerprints have 1."""
    a, b = F.split(one, ":"), F.split(other, ":")
    pairs = F.slice(F.arrays_zip(a.alias("x"), b.alias("y")), 2, sum(n for _, n in SUBSETS))
    used = F.filter(pairs, lambda p: (p["x"] != NONE) | (p["y"] != NONE))
    same = F.filter(used, lambda p: p["x"] == p["y"])
    return F.when(one == other, F.lit(1.0)).when(F.size(used) > 0, F.size(same) / F.size(used)).otherwise(F.lit(0.0))


PLACE = ("known", "id", "h", "nth")


def in_parts(rows: DataFrame, partitions: int) -> DataFrame:
    """``rows`` dealt by ``part``, runs of their order; each part has a guest, the first row of the next (the last part, of the first).

    The borders, one row a part, are found on the order's columns alone.
    """
    n = partitions * PARTS
    keys = rows.select(*PLACE).repartitionByRange(n, *PLACE)
    first = keys.groupBy(F.spark_partition_id().alias("part")).agg(F.min(F.struct(*PLACE)).alias("first"))
    borders = [r["first"] for r in first.orderBy("part").collect()]  # one row a part
    if not borders:
        return rows.withColumn("part", F.lit(0)).withColumn("guest", F.lit(False))
    kind = rows.select(F.struct(*PLACE).alias("first")).schema
    table = rows.sparkSession.createDataFrame([(b,) for b in borders], kind)
    # the borders in groups, so that a row compares itself with two short lists
    width = max(1, round(len(borders) ** 0.5))
    constant = lambda b: F.struct(*[F.lit(b[c]).cast(kind["first"].dataType[c].dataType).alias(c) for c in PLACE])
    groups = [borders[i : i + width] for i in range(0, len(borders), width)]
    heads = F.array(*[constant(g[0]) for g in groups])
    inside = F.array(*[F.array(*[constant(b) for b in g]) for g in groups])
    me = F.struct(*PLACE)
    rows = rows.withColumn("group", F.greatest(F.size(F.filter(heads, lambda b: b <= me)), F.lit(1)))
    at = (F.col("group") - 1) * width + F.size(F.filter(F.element_at(inside, F.col("group")), lambda b: b <= me)) - 1
    rows = rows.withColumn("part", at.cast("int")).drop("group")
    same = F.lit(True)
    for c in PLACE:
        same = same & F.col(f"r.{c}").eqNullSafe(F.col(f"f.first.{c}"))
    guests = rows.alias("r").join(table.alias("f"), same, "left_semi")
    guests = guests.withColumn("part", F.pmod(F.col("part") - 1, F.lit(len(borders))).cast("int"))
    return rows.withColumn("guest", F.lit(False)).unionByName(guests.withColumn("guest", F.lit(True)))


def fingerprints(docs: DataFrame, text_col: str = "text", low: float = 0.005, high: float = 0.2) -> DataFrame:
    """``docs`` with a column ``fingerprint``; the lexicon is counted over all of ``docs``."""
    return with_fingerprint(docs, text_col, "fingerprint", lexicon(docs, text_col, low, high, Scratch(docs.sparkSession)))


def edited_fingerprints(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", low: float = 0.005, high: float = 0.2
) -> DataFrame:
    """Fingerprints of every text and of its edited text, and their likeness to each other and to the next document's.

    In the edited text the last floor(n_chars / 2) code points give way to as
    many first code points of the next document (or all it has); the last
    document is followed by the first.
    """
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    lex = lexicon(docs, text_col, low, high, Scratch(docs.sparkSession))
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = rows.select(
        F.col("id").isNotNull().alias("known"), "id", F.xxhash64("text").alias("h"), F.monotonically_increasing_id().alias("nth"), "text"
    )
    rows = in_parts(rows, partitions)
    rows = with_fingerprint(rows, "text", "fingerprint", lex)
    ahead = Window.partitionBy("part").orderBy("guest", *PLACE)
    rows = rows.withColumn("next_text", F.lead("text").over(ahead)).withColumn("next_fingerprint", F.lead("fingerprint").over(ahead))
    rows = rows.where(~F.col("guest")).withColumn("n_chars", F.char_length("text").cast("long"))
    half = F.floor(F.col("n_chars") / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), F.col("n_chars").cast("int") - half), F.substring("next_text", F.lit(1), half))
    rows = rows.select("id", "n_chars", edited.alias("edited"), "fingerprint", "next_fingerprint")
    rows = rows.withColumn("edited_sha256", F.sha2(F.encode("edited", "UTF-8"), 256))
    rows = with_fingerprint(rows, "edited", "edited_fingerprint", lex)
    return rows.select(
        F.col("id").alias(id_col),
        "n_chars",
        "edited_sha256",
        "fingerprint",
        "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"),
    )
