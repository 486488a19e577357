"""Canonical exact fingerprints of documents, in SQL functions alone.

Canonical form: Unicode normalisation to composed compatibility characters (NFKC), full case
folding, normalisation again, then runs of white space become one blank and the ends are trimmed.
The fingerprint is a 128-bit xxhash of that form. :func:`exact_groups` groups documents by it and
compares the canonical bytes inside equal buckets: texts that collide there get variants, and
fingerprints of their own.

Normalisation and folding are Spark's ``reflect`` function over the Unicode library that Spark
itself uses for its collations; texts of ASCII alone only pay for lower-casing.

Edge cases: a null text is an empty text, and all empty texts (also of white space only) share a
fingerprint; texts of any length count whole; repeated ids are rows of their own, and follow each
other by fingerprint; null ids come after all others, by fingerprint; an empty table gives an empty
result; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import durable

#: White space that normalisation leaves as it is.
_BLANKS = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\u0085\u1680\u2028\u2029"


def _normalized(text: Column) -> Column:
    return F.reflect(F.lit("com.ibm.icu.text.Normalizer"), F.lit("compose"), text, F.lit(True))


def canonical(text: Column) -> Column:
    """The canonical form of a text (null: empty)."""
    text = F.coalesce(text, F.lit(""))
    folded = F.reflect(F.lit("com.ibm.icu.lang.UCharacter"), F.lit("foldCase"), _normalized(text), F.lit(True))
    plain = F.octet_length(text) == F.length(text)
    told = F.translate(F.when(plain, F.lower(text)).otherwise(_normalized(folded)), _BLANKS, " " * len(_BLANKS))
    return F.trim(F.regexp_replace(told, " {2,}", " "))


def digest128(canon: Column) -> Column:
    """32 hexadecimal digits: xxhash64 of the text, and of the text after a salt."""
    return F.lower(F.concat(F.lpad(F.hex(F.xxhash64(canon)), 16, "0"), F.lpad(F.hex(F.xxhash64(F.lit("second half"), canon)), 16, "0")))


def fingerprint(text: Column) -> Column:
    return digest128(canonical(text))


def digested(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text (null: empty), digest of each row of docs, written once: no later step digests a document again."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    return durable(rows.withColumn("digest", fingerprint(F.col("text"))), "fp-texts", "zstd")


def digest_groups(texts: DataFrame) -> DataFrame:
    """digest, variant, canon, group_id (smallest id of the group), copies: a row for each distinct canonical text.

    texts: as :func:`digested` gives them. Digests are counted first; only texts whose digest has
    company are made canonical again and grouped by their bytes, which Spark combines within each map task. canon is null unless different texts share the
    digest; these are variants 0, 1 and so on, by their smallest ids, then by their bytes.
    """
    counted = durable(texts.groupBy("digest").agg(F.count(F.lit(1)).alias("copies"), F.min("doc_id").alias("group_id")), "fp-digests")
    company = counted.where("copies > 1").select("digest")
    texts = texts.join(company, "digest", "left_semi").groupBy("digest", canonical(F.col("text")).alias("canon")).agg(F.count(F.lit(1)).alias("copies"), F.min("doc_id").alias("group_id"))
    # Where a digest has one text only, as is all but certain, the text has done its duty.
    of_digest = Window.partitionBy("digest")
    by_bytes = F.row_number().over(of_digest.orderBy(F.col("group_id").asc_nulls_last(), "canon")) - 1
    proved = texts.withColumns({"n": F.count(F.lit(1)).over(of_digest), "variant": by_bytes})
    several = proved.select("digest", "variant", F.when(F.col("n") > 1, F.col("canon")).alias("canon"), "group_id", "copies")
    single = counted.where("copies = 1").select("digest", F.lit(0).alias("variant"), F.lit(None).cast("string").alias("canon"), "group_id", "copies")
    return durable(single.unionByName(several), "fp-groups")


def _named(rows: DataFrame, groups: DataFrame, canon: str, digest: str, out: str) -> DataFrame:
    """Adds the fingerprint of a canonical text: its digest, and its variant where that is not 0."""
    variants = groups.where("variant > 0")
    if variants.isEmpty():
        return rows.withColumn(out, F.col(digest))
    told = variants.select(F.col("digest").alias("__digest"), F.col("canon").alias("__canon"), F.col("variant").alias("__variant"))
    met = rows.join(told, (F.col(digest) == F.col("__digest")) & (F.col(canon) == F.col("__canon")), "left")
    return met.withColumn(out, F.concat(F.col(digest), F.coalesce(F.concat(F.lit("-"), F.col("__variant")), F.lit("")))).drop("__digest", "__canon", "__variant")


def _by_fingerprint(groups: DataFrame) -> DataFrame:
    suffix = F.when(F.col("variant") > 0, F.concat(F.lit("-"), F.col("variant"))).otherwise("")
    return groups.select(F.concat("digest", suffix).alias("fingerprint"), "variant", "group_id", "copies")


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fingerprint, variant, group_id (smallest id of the group), copies for each row of docs."""
    texts = digested(docs, id_col, text_col)
    groups = digest_groups(texts)
    named = _named(texts.withColumn("canon", canonical(F.col("text"))), groups, "canon", "digest", "fingerprint").select("doc_id", "fingerprint")
    return named.join(_by_fingerprint(groups), "fingerprint").select("doc_id", "fingerprint", "variant", "group_id", "copies")


def with_successor(rows: DataFrame, at: Column, carried: list[str], block: int = 256) -> DataFrame:
    """Adds, for each carried column c, next_c of the row with the next greater number ``at`` (last: the first).

    Keys are cut into blocks of consecutive values, and a window inside each block finds the
    successors. The first rows of a block are sent to the block before it, too, so that its last
    row finds its successor there; which rows these are follows from the keys alone. So carried
    columns are shuffled once. Rows with equal keys follow each other in the order of the carried
    columns.
    """
    place = lambda c: F.floor(c / F.lit(block)).cast("long")
    keys = rows.select(at.alias("at"))
    heads = keys.groupBy(place(F.col("at")).alias("block")).agg(F.min("at").alias("head"))
    links = _next_block(heads.select("block"), 1)
    before = durable(links.join(heads.withColumnRenamed("block", "of"), F.col("next_block") == F.col("of")).select("head", F.col("block").alias("previous")), "fp-heads")
    met = rows.withColumn("at", at).join(before, F.col("at") == F.col("head"), "left")
    sent = F.array_compact(F.array(F.struct(place(F.col("at")).alias("block"), F.lit(False).alias("copy")), F.when(F.col("previous").isNotNull(), F.struct(F.col("previous").alias("block"), F.lit(True).alias("copy")))))
    dealt = met.withColumn("to", F.explode(sent)).select(*rows.columns, "at", "to.block", "to.copy")
    w = Window.partitionBy("block").orderBy("copy", "at", *carried)
    # The first row of a copied tie is the successor; the others of the tie follow it in its own block.
    seen = dealt.withColumns({f"next_{c}": F.lead(F.struct(c)).over(w) for c in carried}).where("not copy")
    return seen.select(*rows.columns, *[F.col(f"next_{c}")[c].alias(f"next_{c}") for c in carried])


def _next_block(blocks: DataFrame, levels: int, factor: int = 1024) -> DataFrame:
    """block, next_block (the greatest: the smallest) over distinct numbers."""
    if levels == 0:
        first = F.first("block").over(Window.orderBy("block").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
        return blocks.select("block", F.coalesce(F.lead("block").over(Window.orderBy("block")), first).alias("next_block"))
    upper = blocks.withColumn("upper", F.floor(F.col("block") / F.lit(factor)).cast("long"))
    w = Window.partitionBy("upper").orderBy("block")
    seen = upper.withColumns({"next_block": F.lead("block").over(w)})
    heads = upper.groupBy("upper").agg(F.min("block").alias("head"))
    link = _next_block(heads.select(F.col("upper").alias("block")), levels - 1, factor)
    step = link.join(heads, F.col("next_block") == F.col("upper")).select(F.col("block").alias("upper"), "head")
    return seen.join(step, "upper").select("block", F.coalesce("next_block", "head").alias("next_block"))


def edited_likeness(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """For each document its fingerprint and group, the fingerprint of its edited text, and their likeness (0 or 1).

    Edited: the last floor(n/2) code points give way to the first as many of the next document.
    Equal fingerprints stand for equal canonical bytes: documents through :func:`digest_groups`,
    a document and its edited text by a comparison of the two.
    """
    texts = digested(docs, id_col, text_col)
    groups = digest_groups(texts)
    # The canonical form is made only where there are variants to tell apart.
    rows = _named(texts.withColumn("canon", canonical(F.col("text"))), groups, "canon", "digest", "fingerprint").drop("canon", "digest")
    # Null ids are spread by their fingerprints, so that they don't all stand in one block.
    spread = F.conv(F.left("fingerprint", F.lit(5)), 16, 10).cast("long") * 1024
    linked = with_successor(rows, F.coalesce(F.col("doc_id"), F.lit(1 << 62) + spread), ["fingerprint", "text"])
    n = F.length("text").cast("long")
    half = F.floor(n / 2).cast("int")
    edited = linked.withColumns({"n_chars": n, "edited": F.concat(F.left("text", (n - half).cast("int")), F.left("next_text", half))})
    edited = edited.withColumn("edited_canon", canonical(F.col("edited"))).withColumn("edited_digest", digest128(F.col("edited_canon")))
    edited = _named(edited, groups, "edited_canon", "edited_digest", "edited_fingerprint")
    same = F.when(F.col("fingerprint") == F.col("edited_fingerprint"), F.col("edited_canon") == canonical(F.col("text"))).otherwise(False)
    told = edited.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "fingerprint", "edited_fingerprint",
        same.cast("double").alias("near_edited"), (F.col("fingerprint") == F.col("next_fingerprint")).cast("double").alias("near_next"),
    )
    return told.join(_by_fingerprint(groups).drop("variant"), "fingerprint").select(*told.columns, "group_id", "copies")
