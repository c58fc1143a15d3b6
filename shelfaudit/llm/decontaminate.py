"""Benchmark decontamination by a prefix-filtered set join, in DataFrame operations only.

Method: a benchmark item is cut into windows of ``window`` words (a shorter
item is one window), a window into shingles of ``shingle`` words. Shingles are
ordered by rarity, counted over all documents. A window can occur in a
document only if each of its shingles does, so the prefix that has to be
joined is its rarest one (and a window with a shingle that no document holds
is out). Joined places are kept if the window fits the document (length) and
starts at the place's offset (position), and are verified by comparing every
shingle of the window with the document's at consecutive places, which is
exact containment of the window's words.

Scale: documents are read once, whatever the items' lengths. Their words meet
the benchmark's shingles in a broadcast join if these are up to ``BLOCK``. Of a
larger benchmark only bitmaps of its shingles' hashes are broadcast (one a
length, 2^SIEVE_BITS bits at most); the places that pass one, few more than those that hold a
shingle, are joined by a shuffle. What goes on are only the places that hold
some benchmark shingle, as numbers, and one row a document. Texts never move.
Rows of one document meet in one task, never those of a shingle or window;
the join of places with prefixes can be split by AQE.

Defined results: a null or empty text has no words and is clean; an item
without words is in no window; equal windows of several items count for each
of them; repeated documents have the same result each; item ids are compared
as strings, a null id as the empty one; an empty benchmark leaves all clean;
other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfaudit.llm.common import ALNUM_WORD, lower_az
from shelfaudit.session import stage

#: Shingles that are broadcast (about 100 bytes each); more are joined by a shuffle.
BLOCK = 200_000
#: A bitmap in front of that shuffle has at least SIEVE_SPACE bits a shingle, up to 2^SIEVE_BITS (64 MiB).
SIEVE_SPACE, SIEVE_BITS = 16, 29
#: Bits of one bitmap row, as Spark's bitmap functions have it.
BITMAP = 32_768


def words(text: Column) -> Column:
    return F.regexp_extract_all(lower_az(text), F.lit(ALNUM_WORD), F.lit(0))


def _windows(benchmark: DataFrame, window: int, shingle: int, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """(windows: window_id, len, k, grams; items: window_id, item), both staged."""
    w = benchmark.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("item"), words(F.col(text_col)).alias("w")).filter(F.size("w") > 0)
    length = f"least({window}, size(w))"
    each = w.select("item", F.explode(F.expr(f"transform(sequence(0, size(w) - {length}), i -> slice(w, i + 1, {length}))")).alias("win")).distinct()
    distinct = stage(each.select("win").distinct().withColumn("window_id", F.monotonically_increasing_id()), "decon-windows")
    k = f"least({shingle}, size(win))"
    grams = F.expr(f"transform(sequence(0, size(win) - {k}), j -> slice(win, j + 1, {k}))")
    windows = distinct.select("window_id", F.size("win").alias("len"), F.expr(k).alias("k"), grams.alias("grams"))
    return windows, stage(each.join(distinct, "win").select("window_id", "item"), "decon-items")


def _places(docs: DataFrame, grams: DataFrame, shingle: int, id_col: str, text_col: str) -> DataFrame:
    """Rows (id, th, n_words, head, pos, gram_id, k): one with ``head`` for each document, and those with a
    ``gram_id`` for each place that holds a shingle of ``grams`` (gram_id, k, g); a row can be both."""
    text = F.col(text_col)
    w = docs.select(F.col(id_col).alias("id"), F.xxhash64(F.coalesce(text, F.lit(""))).alias("th"), words(text).alias("w"))
    lanes = F.arrays_zip(*[(F.slice("w", j + 1, F.size("w")) if j else F.col("w")).alias(f"w{j}") for j in range(shingle)])
    at = w.select("id", "th", F.size("w").alias("n_words"), F.posexplode_outer(lanes).alias("pos", "x"))
    n = grams.count()
    lengths = sorted(r.k for r in grams.select("k").distinct().collect()) or [shingle]  # 1 to shingle
    known = {
        k: grams.filter(F.col("k") == k)
        .select(F.col("gram_id").alias(f"gram{k}"), *[F.get("g", F.lit(j)).alias(f"g{k}_{j}") for j in range(k)])
        .withColumn(f"gh{k}", F.xxhash64(*[f"g{k}_{j}" for j in range(k)]))
        for k in lengths
    }
    for k in lengths:
        own = [F.col("x").getField(f"w{j}") for j in range(k)]
        # a place too near the text's end holds no shingle; a hash of its own keeps such places apart in a shuffle
        at = at.withColumn(f"h{k}", F.when(own[-1].isNotNull(), F.xxhash64(*own)).otherwise(F.xxhash64("th", "id", "pos")))
    head = F.coalesce("pos", F.lit(0)) == 0
    if n > BLOCK:
        at = _sieved(at, known, n, head)
    for k in lengths:
        # the hash alone is the join key, a whole number; the words themselves are compared on each hit
        same = F.lit(True)
        for j in range(k):
            same = same & (F.col("x").getField(f"w{j}") == F.col(f"g{k}_{j}"))
        met = (F.col(f"h{k}") == F.col(f"gh{k}")) & F.coalesce(same, F.lit(False))
        at = at.join(known[k] if n > BLOCK else F.broadcast(known[k]), met, "left")
    held = F.array_compact(F.array(*[F.when(F.col(f"gram{k}").isNotNull(), F.struct(F.lit(k).alias("k"), F.col(f"gram{k}").alias("gram_id"))) for k in lengths]))
    stays = head
    for k in lengths:
        stays = stays | F.col(f"gram{k}").isNotNull()
    met = at.filter(stays).select("id", "th", "n_words", "pos", head.alias("first"), held.alias("held"))
    met = met.select("id", "th", "n_words", "first", "pos", F.posexplode_outer("held").alias("nth", "one"))
    return met.select("id", "th", "n_words", (F.col("first") & (F.coalesce("nth", F.lit(0)) == 0)).alias("head"), "pos", "one.gram_id", "one.k")


def _sieved(at: DataFrame, known: dict[int, DataFrame], n: int, head: Column) -> DataFrame:
    """Rows of ``at`` that are a document's head or whose hash of some length has its bit in a bitmap of the known hashes."""
    bits = 1 << min(SIEVE_BITS, max(BITMAP, n * SIEVE_SPACE).bit_length())

    def row(h: str) -> Column:
        return F.floor(F.pmod(F.col(h), F.lit(bits)) / BITMAP).cast("int")

    def bit(h: str) -> Column:
        return F.pmod(F.col(h), F.lit(BITMAP)).cast("int")

    passes = head
    for k, grams in known.items():
        maps = grams.groupBy(row(f"gh{k}").alias(f"m{k}")).agg(F.bitmap_construct_agg(bit(f"gh{k}").cast("long")).alias(f"bitmap{k}"))
        byte = F.conv(F.hex(F.substring(f"bitmap{k}", F.floor(bit(f"h{k}") / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
        at = at.join(F.broadcast(maps), row(f"h{k}") == F.col(f"m{k}"), "left")  # bits / 8 bytes at most
        passes = passes | F.coalesce(F.getbit(byte, bit(f"h{k}") % 8) == 1, F.lit(False))
    return at.filter(passes).drop(*[f"{name}{k}" for k in known for name in ("m", "bitmap")])


def _verified(places: DataFrame, parts: DataFrame, windows: DataFrame, window: int) -> DataFrame:
    """Occurrences (id, th, start, len, window_id) from the prefix join."""
    found = places.filter(F.col("gram_id").isNotNull()).select("id", "th", "n_words", "pos", "gram_id", "k")
    found = found.dropDuplicates(["id", "th", "pos", "gram_id"])  # repeated documents, combined before they move
    rarity = places.filter(F.col("gram_id").isNotNull()).groupBy("gram_id").agg(F.count(F.lit(1)).alias("seen"))
    prefix = (
        parts.join(rarity, "gram_id").groupBy("window_id")
        .agg(F.count(F.lit(1)).alias("present"), F.min(F.struct("seen", "j", "gram_id")).alias("rarest"))
        .join(windows, "window_id")
        .filter(F.col("present") == F.size("gram_ids"))
        .select("window_id", "len", "gram_ids", F.col("rarest.j").alias("j"), F.col("rarest.gram_id").alias("gram_id"))
    )
    # what the document holds around each place: at most window - 1 shingles on either side
    near = Window.partitionBy("id", "th", "k").orderBy("pos").rowsBetween(1 - window, window - 1)
    around = found.select("id", "th", "n_words", "pos", "gram_id", F.collect_list("pos").over(near).alias("ps"), F.collect_list("gram_id").over(near).alias("gs"))
    start = F.col("pos") - F.col("j")
    m = F.size("gram_ids")
    i = F.array_position("ps", F.col("start"))
    return (
        around.join(prefix, "gram_id").withColumn("start", start)
        .filter((F.col("start") >= 0) & (F.col("start") + F.col("len") <= F.col("n_words")))
        .filter((i > 0) & (F.get("ps", (i + m - 2).cast("int")) == F.col("start") + m - 1))
        .filter(F.slice("gs", F.greatest(i, F.lit(1)).cast("int"), m) == F.col("gram_ids"))
        .select("id", "th", "start", "len", "window_id")
    )


def occurrences(docs: DataFrame, benchmark: DataFrame, window: int = 10, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text") -> tuple[DataFrame, DataFrame, DataFrame]:
    """(documents: id, th, n_words; occurrences: id, th, start, len, window_id; items: window_id, item).

    ``th``, a hash of the text, tells rows of a repeated id apart.
    """
    windows, items = _windows(benchmark, window, shingle, item_id_col, item_text_col)
    grams = windows.select("window_id", "len", "k", F.posexplode("grams").alias("j", "g"))
    ids = stage(grams.select("k", "g").distinct().withColumn("gram_id", F.monotonically_increasing_id()), "decon-grams")
    parts = stage(grams.join(ids, ["k", "g"]).select("window_id", "len", "j", "gram_id"), "decon-parts")
    in_order = F.transform(F.array_sort(F.collect_list(F.struct("j", "gram_id"))), lambda x: x["gram_id"])
    coded = parts.groupBy("window_id", "len").agg(in_order.alias("gram_ids"))
    places = stage(_places(docs, ids, shingle, id_col, text_col), "decon-places")
    hits = stage(_verified(places, parts.select("window_id", "j", "gram_id"), coded, window), "decon-hits")
    return places.filter("head").select("id", "th", "n_words"), hits, items


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = 10, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """One row (id, n_words, n_hit, n_items, items_sha256, contaminated) per row of ``docs``."""
    documents, hits, items = occurrences(docs, benchmark, window, shingle, id_col, text_col, item_id_col, item_text_col)
    end = F.col("start") + F.col("len")
    before = F.max(end).over(Window.partitionBy("id", "th").orderBy("start", "len").rowsBetween(Window.unboundedPreceding, -1))
    covered = hits.select("id", "th", "start", "len").distinct().withColumn("before", before)
    n_hit = covered.groupBy("id", "th").agg(F.sum(F.greatest(F.lit(0), end - F.greatest("start", F.coalesce("before", F.lit(0))))).alias("n_hit"))
    held = (
        hits.select("id", "th", "window_id").distinct().join(items, "window_id")
        .groupBy("id", "th").agg(F.sort_array(F.collect_set("item")).alias("held"))
    )
    out = documents
    for k, more in enumerate((n_hit, held)):
        more = more.withColumnsRenamed({"id": f"id{k}", "th": f"th{k}"})
        out = out.join(more, F.col("id").eqNullSafe(F.col(f"id{k}")) & (F.col("th") == F.col(f"th{k}")), "left")
    return out.select(
        "id", F.col("n_words").cast("long"), F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce(F.size("held"), F.lit(0)).cast("long").alias("n_items"),
        F.sha2(F.coalesce(F.concat_ws(",", "held"), F.lit("")), 256).alias("items_sha256"),
        F.col("n_hit").isNotNull().alias("contaminated"),
    )
