"""Benchmark decontamination by winnowing, in DataFrame functions only.

Every run of k words is hashed, and of each w runs that follow each other the least hash is kept.  Two texts that share
k + w - 1 words then share a kept hash, so with k + w - 1 at most the length of a window no shared window is missed,
while two of seven hashes or so have to be compared.  Kept hashes of documents and benchmark items are joined; each hit
is extended word by word to both sides, on the words themselves, and counts where a whole window agrees.  Items
shorter than a window are windows of their own length: k is that length and every hash is kept.

Hash and place travel as one long (34 bits of hash, 30 of place), which makes the window minimum a comparison of longs
and ties go to the first place in both texts.  Documents move once at most: hits are narrow rows, and only the words
around them are read again.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorloom.llm.tables import stored, unused

NOT_WORD_YET = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"  # before A-Z are put in lower case
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
GRAM = 5
PLACE_BITS = 30


def words_of(text: Column) -> Column:
    """Words of a text in order, A-Z in lower case and no other letter changed; none for null."""
    ascii_only = F.length(text) == F.octet_length(text)
    lower = F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))
    # the ends of the text can leave an empty word
    return F.coalesce(F.array_remove(F.split(lower, NOT_WORD), ""), F.array().cast("array<string>"))


def grams(words: Column, k: int) -> Column:
    """Hash and place of every run of ``k`` words as one long each."""
    hashes = F.transform(words, lambda w: F.xxhash64(w))
    last = F.size(words) - k

    def one(h: Column, i: Column) -> Column:
        parts = [F.get(h, i + j) for j in range(k)]
        return F.shiftleft(F.xxhash64(*parts), PLACE_BITS).bitwiseOR(i.cast("long"))

    # the word hashes are made once and named, else every run would make them anew
    named = F.transform(F.array(hashes), lambda h: F.transform(F.sequence(F.lit(0), last), lambda i: one(h, i)))[0]
    return F.when(last >= 0, named).otherwise(F.array().cast("array<bigint>"))


def winnow(codes: Column, w: int) -> Column:
    """The least of each ``w`` codes in a row, each once; of fewer codes the least of all."""
    if w == 1:
        return codes
    last = F.size(codes) - w
    least = F.transform(
        F.array(codes),
        lambda c: F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), lambda i: F.least(*[F.get(c, i + j) for j in range(w)])),
    )[0]
    # the least moves on only: equal ones follow each other
    return F.when(F.size(codes) > 0, F.array_distinct(least)).otherwise(codes)


def _prints(rows: DataFrame, k: int, w: int) -> DataFrame:
    """The columns of ``rows`` with ``hash, place`` of the kept runs of ``words``."""
    others = [c for c in rows.columns if c != "words"]
    codes = rows.withColumn("codes", grams(F.col("words"), k)).withColumn("kept", winnow(F.col("codes"), w))
    place = F.lit((1 << PLACE_BITS) - 1).cast("long")
    # explode() would put a filter on the size of the array below the steps that make it, and make it twice
    return codes.select(*others, "words", F.explode_outer("kept").alias("code")).where("code is not null").select(
        *others, "words", F.shiftright("code", PLACE_BITS).alias("hash"), F.col("code").bitwiseAND(place).cast("int").alias("place")
    )


def _context(words: Column, place: Column, n: Column, k: Column) -> tuple[Column, Column]:
    """The words that windows holding the run at ``place`` can reach, and the run's place among them."""
    left = F.least(place, n - k)
    return F.slice(words, place - left + 1, left + n), left


def _agree(mine: Column, theirs: Column, i: Column, j: Column, step: int, most: int) -> Column:
    """How many words agree one after the other from the places ``i`` and ``j`` on, at most ``most``."""
    total, so_far = F.lit(0), F.lit(True)
    for d in range(most):
        so_far = so_far & F.coalesce(F.get(mine, i + step * d) == F.get(theirs, j + step * d), F.lit(False))
        total = total + so_far.cast("int")
    return total


def spans(docs: DataFrame, items: DataFrame, window: int = 10) -> DataFrame:
    """``row_key, item_id, start, end``: stretches of document words made of windows of an item.

    ``docs`` has ``row_key`` and ``text``, ``items`` has ``item_id`` and ``text``.
    """
    item_words = items.select("item_id", words_of(F.col("text")).alias("words")).where(F.size("words") > 0)
    item_words = stored(item_words.withColumn("n", F.least(F.size("words"), F.lit(window))), "winnow-items")
    lengths = sorted(r["n"] for r in item_words.select("n").distinct().collect())  # at most `window` numbers
    words = docs.select("row_key", words_of(F.col("text")).alias("words"))
    kept, hits = [], []
    for n in lengths:
        k = GRAM if n == window and n > GRAM else n
        context, at = _context(F.col("words"), F.col("place"), F.lit(n), F.lit(k))
        theirs = _prints(item_words.where(F.col("n") == n).select("item_id", "words"), k, n - k + 1)
        theirs = stored(theirs.select("hash", "item_id", context.alias("theirs"), at.alias("there"), F.lit(n).alias("n"), F.lit(k).alias("k")), "winnow-prints")
        kept.append(theirs)
        mine = _prints(words, k, n - k + 1).select("row_key", "hash", "place")
        hits.append(mine.join(theirs.select("hash").distinct(), "hash", "left_semi").withColumns({"n": F.lit(n), "k": F.lit(k)}))
    if not hits:
        nothing = items.select(F.lit("").alias("row_key"), "item_id", F.lit(0).alias("start"), F.lit(0).alias("end"))
        return nothing.where(F.lit(False))
    # places that met a benchmark hash, listed per document: no more than it has words
    met = stored(reduce(DataFrame.unionByName, hits).distinct(), "winnow-hits")
    per_document = met.groupBy("row_key").agg(F.collect_list(F.struct("hash", "place", "n", "k")).alias("met"))
    again = docs.select("row_key", "text").join(per_document, "row_key").select("row_key", words_of(F.col("text")).alias("words"), "met")
    one = again.select("row_key", "words", F.explode("met").alias("m")).select("row_key", "words", "m.*")
    context, at = _context(F.col("words"), F.col("place"), F.col("n"), F.col("k"))
    around = one.select("row_key", "hash", "place", "n", "k", context.alias("mine"), at.alias("here"))
    pairs = around.join(reduce(DataFrame.unionByName, kept), ["hash", "n", "k"])
    onward = _agree(F.col("mine"), F.col("theirs"), F.col("here"), F.col("there"), 1, window)
    back = _agree(F.col("mine"), F.col("theirs"), F.col("here") - 1, F.col("there") - 1, -1, window - 1)
    sized = pairs.select("row_key", "item_id", "place", "n", "k", onward.alias("onward"), back.alias("back")).where("onward >= k")
    # only the windows that hold this run whole: the others have a kept run of their own
    start = F.col("place") - F.least(F.col("back"), F.col("n") - F.col("k"))
    end = F.col("place") + F.least(F.col("onward"), F.col("n"))
    found = sized.select("row_key", "item_id", start.alias("start"), end.alias("end"), "n")
    return found.where(F.col("end") - F.col("start") >= F.col("n")).select("row_key", "item_id", "start", "end").distinct()


def row_key(ident: Column, text: Column) -> Column:
    """Rows with one id and one text have one result, so they may share a key."""
    return F.concat_ws(":", F.xxhash64(text).cast("string"), F.octet_length(text).cast("string"), ident.cast("string"))


def contamination(
    docs: DataFrame,
    items: DataFrame,
    window: int = 10,
    key: str = "doc_id",
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """Per row of ``docs``: ``doc_id, n_words, n_hit, n_items, items_sha256, contaminated``.

    A word is hit if it lies in an occurrence of a window of an item: ``window`` words in a row, or the whole of an item
    with fewer.  Texts that are null, empty or without words have no words and no hits; items without words have no
    window; items with a null id hit words but are not listed.  Rows that repeat id and text have equal results.
    """
    keyed = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text")).withColumn("row_key", row_key(F.col("doc_id"), F.col("text")))
    own = items.select(F.col(item_key).alias("item_id"), F.col(item_text).alias("text"))
    found = stored(spans(keyed, own, window), "winnow-spans")
    hit = (
        found.select("row_key", F.explode(F.sequence("start", F.col("end") - 1)).alias("at"))
        .distinct()
        .groupBy("row_key")
        .agg(F.count(F.lit(1)).alias("n_hit"))
    )
    of_items = found.groupBy("row_key").agg(F.sort_array(F.collect_set(F.col("item_id").cast("string"))).alias("ids"))
    per_key = stored(hit.join(of_items, "row_key"), "winnow-result")
    n_words = F.coalesce(F.size(F.array_remove(F.split("text", NOT_WORD_YET), "")), F.lit(0)).cast("long")
    counted = keyed.select("doc_id", "row_key", n_words.alias("n_words"))
    return counted.join(per_key, "row_key", "left").select(
        "doc_id",
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce(F.size("ids"), F.lit(0)).cast("long").alias("n_items"),
        F.sha2(F.coalesce(F.array_join("ids", ","), F.lit("")), 256).alias("items_sha256"),
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
    )


def clean_documents(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """``docs`` without the rows of which a word is hit."""
    key, text = options.get("key", "doc_id"), options.get("text", "text")
    mark = unused(docs, "row_key")
    marked = docs.withColumn(mark, row_key(F.col(key), F.col(text)))
    own = items.select(F.col(options.get("item_key", "item_id")).alias("item_id"), F.col(options.get("item_text", "text")).alias("text"))
    hit = spans(marked.select(F.col(mark).alias("row_key"), F.col(text).alias("text")), own, options.get("window", 10))
    bad = stored(hit.select(F.col("row_key").alias("bad_key")).distinct(), "winnow-bad")
    return marked.join(bad, marked[mark] == bad["bad_key"], "left_anti").drop(mark)
