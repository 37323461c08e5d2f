"""Document fingerprints from spot signatures, on DataFrame operations only.

A signature is a chain: a common word (the anchor) and the two content words that follow it, other
common words between them skipped. A document's fingerprint is the set of its chains (40-bit
hashes), written as their sorted hexadecimal digits; likeness is the Jaccard similarity of two
sets. Common words of four languages are fixed values. Content words that no chain reaches (stretches
without common words, as in lists and tables) count as pairs of neighbours, so that every word of a
text is in its fingerprint; a text of common words alone has the pairs of all its words.

Neighbours in id order meet through one exchange of the texts: ids are cut at exact quantile
elements (known ids), a row whose id is such an element is copied to the block before it, and each
block is read in order.

``similar_pairs`` compares sets within partitions of similar length: equal sets fold into one
class; a set of length L probes its own length band and the next one, by the rarest chains that any
set of likeness ``threshold`` must share with it; pairs whose lengths rule the threshold out are
dropped before sets are compared.

Cases: null text is empty; an empty text has the empty fingerprint, of likeness 1 to another empty
one and 0 to all else; in descending id order null ids come last and rows of equal id follow their
text's hash; a single row is its own next document; equal texts have equal fingerprints.
"""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.llm.common import pinned, shuffle_partitions

#: common words of English, German, French and Spanish (fixed values)
ANCHORS = """
a an and are as at be been but by for from had has have he her his i in is it its not of on or she that the their them they
this to was were what which who will with you
aber als am an auch auf aus bei das dem den der des die durch ein eine einem einen einer er es für hat ich im in ist mit nach
nicht noch oder sich sie sind so über um und von vor war wenn werden wie wird zu zum zur
au aux avec ce ces cette dans de des du elle en est et eux il ils je la le les leur lui mais ne nous on ou par pas plus pour
qu que qui sa se ses son sont sur un une vous y
al como con de del el ella en entre era es esta este ha hay la las le lo los me más muy no o para pero por que se sin sobre su
sus también un una y ya
""".split()
HASH_BITS = 40
DIGITS = HASH_BITS // 4


def _anchor_pattern() -> str:
    by_letter: dict[str, list[str]] = {}
    for w in sorted(set(ANCHORS)):
        by_letter.setdefault(w[0], []).append(w[1:])
    parts = [f"{a}(?:{'|'.join(sorted(rest, reverse=True))})" for a, rest in by_letter.items()]
    return f"(?<= )(?:({'|'.join(parts)}) )++"


def chains(rows: DataFrame, text: str, out: str) -> DataFrame:
    """Adds ``out``: the sorted distinct chain hashes of ``text``."""
    plain = F.concat(F.lit(" "), F.regexp_replace(F.lower(F.coalesce(F.col(text), F.lit(""))), r"[^\p{L}\p{N}]+", " "), F.lit(" "))
    marked = F.regexp_replace(F.regexp_replace(plain, " +", " "), _anchor_pattern(), "$1#")
    content = F.filter(F.split(marked, " "), lambda x: (x != "") & ~x.endswith("#"))
    d = rows.withColumn("_c", content)
    c = F.col("_c")

    def chain(head: Column, following: Column) -> Column:
        second = F.coalesce(F.substring_index(following, "#", -1), F.lit(""))
        return F.shiftrightunsigned(F.xxhash64(head, second), 64 - HASH_BITS)

    # words that no chain reaches stand in pairs of neighbours; the last of a stretch alone where no pair holds it
    def anchored(i: Column) -> Column:
        return F.coalesce((i >= 0) & F.get(c, i).contains("#"), F.lit(False))

    def signature(x: Column, i: Column) -> Column:
        reached = anchored(i - 1)
        held = (i > 0) & ~anchored(i - 2)
        return F.when(x.contains("#") | (~reached & ((i + 1 < F.size(c)) | ~held)), chain(x, F.get(c, i + 1)))

    d = d.withColumn("_h", F.filter(F.transform(c, signature), lambda h: h.isNotNull()))
    # a text of common words alone has the pairs of all its words
    d = d.withColumn("_w", F.when(F.size("_h") == 0, F.filter(F.split(plain, " "), lambda x: x != "")).otherwise(F.array().cast("array<string>")))
    w, n = F.col("_w"), F.size("_w")
    pairs = F.filter(F.transform(w, lambda x, i: F.when((i + 1 < n) | (n == 1), chain(x, F.get(w, i + 1)))), lambda h: h.isNotNull())
    return d.withColumn(out, F.array_sort(F.array_distinct(F.when(F.size("_h") > 0, F.col("_h")).otherwise(pairs)))).drop("_c", "_h", "_w")


def digits(hashes: Column) -> Column:
    return F.array_join(F.transform(hashes, lambda h: F.lpad(F.hex(h), DIGITS, "0")), "")


def likeness(a: Column, b: Column) -> Column:
    """Jaccard similarity of two sets; 1 for two empty ones."""
    common = F.size(F.array_intersect(a, b))
    both = F.size(a) + F.size(b) - common
    return F.when(both == 0, F.lit(1.0)).otherwise(common / both)


def with_next(rows: DataFrame, doc_id: str, following: dict[str, str], tie: Column, blocks: int | None = None) -> DataFrame:
    """For each column in ``following`` its value in the next row by descending ``doc_id`` (after the
    last: in the first). ``rows`` cross one exchange."""
    x = F.coalesce(-F.col(doc_id).cast("double"), F.lit(1.7e308))
    blocks = blocks or 4 * shuffle_partitions(rows.sparkSession)
    cut = rows.select(x.alias("x")).agg(F.min("x").alias("least"), F.percentile_approx(
        "x", [i / blocks for i in range(1, blocks)] or [0.5], 100 * blocks).alias("cuts")).first()
    cuts = sorted({c for c in cut["cuts"] or [] if c > cut["least"]})
    splits = [float("-inf"), *cuts, float("inf")] if cuts else [float("-inf"), 0.0, float("inf")]
    last = len(cuts) if cuts else (0 if cut["least"] is None or cut["least"] < 0 else 1)
    d = Bucketizer(splits=splits, inputCol="_x", outputCol="_b").transform(rows.withColumn("_x", x))

    def place(block: Column, wrap: bool, copied: bool) -> Column:
        return F.struct(block.cast("int").alias("block"), F.lit(wrap).alias("wrap"), F.lit(copied).alias("copied"))

    places = F.array(place(F.col("_b"), False, False))
    if cuts:
        places = F.when(F.col("_x").isin(cuts), F.concat(places, F.array(place(F.col("_b") - 1, False, True)))).otherwise(places)
    places = F.when(F.col("_x") == F.lit(cut["least"]), F.concat(places, F.array(place(F.lit(last), True, True)))).otherwise(places)
    d = d.withColumn("_p", F.explode(places))
    w = Window.partitionBy("_block").orderBy(F.col("_wrap"), F.col(doc_id).desc_nulls_last(), tie)
    d = d.select("*", F.col("_p.block").alias("_block"), F.col("_p.wrap").alias("_wrap"), F.col("_p.copied").alias("_copied"))
    d = d.select("*", *[F.lead(c).over(w).alias(name) for name, c in following.items()])
    return d.where("not _copied").drop("_x", "_b", "_p", "_block", "_wrap", "_copied")


def fingerprint(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, fingerprint and its set of chains."""
    d = chains(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), "text", "chains")
    return d.select("doc_id", "chains", digits(F.col("chains")).alias("fingerprint"))


def edited_likeness(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of each text and of its edited text (its second half replaced by the beginning
    of the next document), and the likeness to the edited text and to the next document."""
    own = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    own = chains(own, "text", "own")
    both = with_next(own, "doc_id", {"next_text": "text", "next": "own"}, F.xxhash64("text"))
    half = F.floor(F.col("n_chars") / 2).cast("int")
    edited = (both.withColumn("n_chars", F.length("text"))
              .withColumn("edited_text", F.concat(F.substr("text", F.lit(1), F.col("n_chars") - half), F.substr("next_text", F.lit(1), half)))
              .withColumn("edited_sha256", F.sha2("edited_text", 256)).drop("text", "next_text"))
    edited = chains(edited, "edited_text", "edited")
    return edited.select(
        "doc_id", F.col("n_chars").cast("long").alias("n_chars"), "edited_sha256", digits(F.col("own")).alias("fingerprint"),
        digits(F.col("edited")).alias("edited_fingerprint"), likeness(F.col("own"), F.col("edited")).alias("near_edited"),
        likeness(F.col("own"), F.col("next")).alias("near_next"))


def similar_pairs(docs: DataFrame, threshold: float = 0.75, doc_id: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(members: doc_id, class), (links: a, b, likeness): classes of equal sets, and the pairs of
    classes of likeness ``threshold`` or more. Texts without words have no class."""
    prints = pinned(fingerprint(docs, doc_id, text).where(F.size("chains") > 0)
                    .select("doc_id", F.sha2("fingerprint", 256).alias("class"), "chains"))
    sets = prints.groupBy("class").agg(F.first("chains").alias("chains")).withColumn("n", F.size("chains"))
    seen = sets.select(F.explode("chains").alias("h")).groupBy("h").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    rare = (sets.select("class", "n", F.explode("chains").alias("h")).join(seen, "h")
            .groupBy("class", "n").agg(F.array_sort(F.collect_list(F.struct("df", "h"))).alias("by_df")))
    # chains that no other set has come first in the order: they use up the prefix
    prefix = F.col("n") - F.ceil(F.col("n") * threshold) + 1 - (F.col("n") - F.size("by_df"))
    # lengths from L to L / threshold fall into the band of L or the next one
    band = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(1 / threshold))).cast("int")
    probes = pinned(rare.where(prefix > 0).select(
        "class", "n", band.alias("band"), F.explode(F.slice("by_df", F.lit(1), prefix.cast("int"))).alias("p"))
        .select("class", "n", "band", F.col("p.h").alias("h")))
    right = probes.select(F.col("class").alias("b"), F.col("n").alias("nb"), "h", F.explode(F.array(F.col("band"), F.col("band") - 1)).alias("band"))
    left = probes.select(F.col("class").alias("a"), F.col("n").alias("na"), "h", "band")
    fits = (F.col("nb") * threshold <= F.col("na")) & ((F.col("na") < F.col("nb")) | ((F.col("na") == F.col("nb")) & (F.col("a") < F.col("b"))))
    pairs = left.join(right, ["h", "band"]).where(fits).select("a", "b").distinct()
    one = sets.select(F.col("class").alias("a"), F.col("chains").alias("ca"))
    two = sets.select(F.col("class").alias("b"), F.col("chains").alias("cb"))
    links = (pairs.join(one, "a").join(two, "b").select("a", "b", likeness(F.col("ca"), F.col("cb")).alias("likeness"))
             .where(F.col("likeness") >= threshold))
    return prints.select("doc_id", "class"), links
