"""Benchmark decontamination by canonical templates (DataFrame functions only).

Texts become sequences of template tokens: numbers, names (runs of words that
hold a capital) and units after a number are replaced with typed placeholders,
other words are lower case, punctuation goes. Windows of five template tokens
are hashed and joined, the benchmark's windows with the documents'. Distinct
windows of one item in a bounded stretch of one document are counted, over
neighbouring diagonals (place in the document less place in the item), so that
a word more or less does not split an item. Where they cover at least 0.8 of
the item's windows, the original values behind the placeholders are laid side
by side, each on the diagonal of its window, and the item is reported if its
slots are filled consistently: each value of the item always stands opposite
the same value of the document. An exact copy fills every slot with itself; a
re-parameterised question fills them anew. Capitals decide what is a name, so
all of this is done once more with texts and items in lower case, where names
are plain words: that finds copies whose capitals were changed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelrank.llm.common import materialise

WINDOW = 5
THRESHOLD = 0.8
#: A window tells texts apart only if it holds so many words that are no placeholder.
LITERALS = 2
#: Diagonals at most half an item apart (so many tokens at least) count together.
MARGIN = 8
#: Rows of benchmark windows (or candidates) sent to every executor at most: 20 to 40 bytes each.
BROADCAST_ROWS = 1_000_000

TOKEN = r"[0-9]+(?:[.,:/][0-9]+)*|\p{Lu}[\p{L}\p{M}]*(?: \p{Lu}[\p{L}\p{M}]*)*|[\p{L}\p{M}]+|[%$€£°]"
UNITS = ["%", "$", "€", "£", "°", "mm", "cm", "dm", "m", "km", "mg", "g", "kg", "t", "ml", "cl", "l", "s", "sec",
         "min", "h", "hr", "hz", "w", "kw", "v", "kb", "mb", "gb", "usd", "eur", "inch", "inches", "foot", "feet",
         "yard", "yards", "mile", "miles", "ounce", "ounces", "pound", "pounds", "gram", "grams", "kilogram",
         "kilograms", "meter", "meters", "metre", "metres", "kilometer", "kilometers", "kilometre", "kilometres",
         "liter", "liters", "litre", "litres", "second", "seconds", "minute", "minutes", "hour", "hours", "day",
         "days", "week", "weeks", "month", "months", "year", "years", "degree", "degrees", "percent", "dollar",
         "dollars", "euro", "euros", "cent", "cents"]


def raw_tokens(text: str | Column) -> Column:
    return F.regexp_extract_all(text, F.lit(TOKEN), F.lit(0))


def _is_number(token: Column) -> Column:
    return (token >= "0") & (token < ":")


def _template(raw: Column) -> Column:
    """Placeholders <n>, <u>, <a> or the word itself, one per raw token."""
    def one(token: Column, i: Column) -> Column:
        unit = token.isin(UNITS) & (i > 0) & _is_number(F.get(raw, i - 1))
        # a lower-case first letter settles most words; accents come after "z" and take the long way
        plain = (token >= "a") & (token < "{") & (F.lower(token) == token)
        return (F.when(plain & ~unit, token).when(_is_number(token), "<n>").when(unit, "<u>")
                .when(F.lower(token) != token, "<a>").otherwise(token))
    return F.transform(raw, one)


def _starts(array: str) -> Column:
    """Places where a whole window starts (none in shorter texts)."""
    last = F.size(array) - WINDOW
    return F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("h"), "text")


def _readings(raw: str) -> Column:
    """Array of the raw tokens as they stand, and those of the text in lower case."""
    folded = F.flatten(F.transform(raw, lambda t: F.split(F.lower(t), " ")))
    return F.array(F.col(raw), folded)


def item_templates(benchmark: DataFrame) -> DataFrame:
    """item_id, fold (0: as it stands, 1: in lower case), raw, tpl, h of each
    distinct benchmark row with a text."""
    raw = (benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").distinct()
           .filter("item_id is not null and text is not null").withColumn("raw", raw_tokens("text")))
    read = raw.select("item_id", F.xxhash64("text").alias("h"), F.posexplode(_readings("raw")).alias("fold", "raw"))
    return read.withColumn("tpl", _template(F.col("raw")))


def item_windows(items: DataFrame) -> DataFrame:
    """(item_id, item_h, fold, n_windows, margin, ipos, w): the informative windows of each item."""
    literal = F.transform("tpl", lambda t: F.when(t.startswith("<"), 0).otherwise(1))
    each = F.transform(_starts("tpl"), lambda i: F.struct(
        i.alias("ipos"),
        F.xxhash64(*[F.xxhash64(F.get("tpl", i + k)) for k in range(WINDOW)]).alias("w"),
        sum((F.get("lit", i + k) for k in range(WINDOW)), F.lit(0)).alias("words")))
    informative = F.filter(each, lambda x: x["words"] >= LITERALS)
    found = items.withColumn("lit", literal).withColumn("ws", informative)
    margin = F.greatest(F.lit(MARGIN), F.floor(F.size("tpl") / 2).cast("int"))
    keys = ["item_id", "item_h", "fold", "n_windows", "margin"]
    return found.select("item_id", F.col("h").alias("item_h"), "fold", F.size("ws").alias("n_windows"),
                        margin.alias("margin"), F.explode("ws").alias("e")).select(*keys, "e.ipos", "e.w")


def _bounded(df: DataFrame) -> DataFrame:
    """Hinted for broadcast if it was counted to be small, else left to Spark."""
    return F.broadcast(df) if df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else df


def candidates(docs: DataFrame, windows: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, h, item_id, item_h, fold, containment, straight, steps) of the places
    that cover enough of an item. ``steps`` are the diagonals used, (-windows,
    diag, places), the one with most windows first; ``straight`` is a place on
    one diagonal of the text as it stands."""
    tokens = _rows(docs).select("doc_id", "h", raw_tokens("text").alias("raw"))
    read = tokens.select("doc_id", "h", F.posexplode_outer(_readings("raw")).alias("fold", "raw"))
    hashed = read.select("doc_id", "h", "fold", F.transform(_template(F.col("raw")), lambda t: F.xxhash64(t)).alias("t"))
    starts = F.transform(_starts("t"), lambda i: F.xxhash64(*[F.get("t", i + k) for k in range(WINDOW)]))
    # The outer form: for the plain one Spark infers a filter on the array's size and, pushing it
    # down, would make the tokens anew for each window. Its null rows join nothing.
    seen = hashed.select("doc_id", "h", "fold", F.posexplode_outer(starts).alias("dpos", "w"))
    hits = seen.join(_bounded(windows), ["w", "fold"]).withColumn("diag", F.col("dpos") - F.col("ipos"))
    # Bands of two margins overlap by one: diagonals a margin apart meet in one of them.
    low = F.floor(F.col("diag") / F.col("margin"))
    bands = hits.withColumn("band", F.explode(F.array(low - 1, low))).groupBy(
        "doc_id", "h", "item_id", "item_h", "fold", "n_windows", "band").agg(
        F.collect_set(F.struct("diag", "ipos")).alias("hits"))
    covering = bands.filter(F.size(F.array_distinct("hits.ipos")) / F.col("n_windows") >= threshold)

    def step(diag: Column) -> Column:
        places = F.transform(F.filter("hits", lambda x: x["diag"] == diag), lambda x: x["ipos"])
        return F.struct((-F.size(places)).alias("neg"), diag.alias("diag"), F.array_sort(places).alias("places"))

    steps = covering.withColumn("steps", F.array_sort(F.transform(F.array_distinct("hits.diag"), step)))
    ways = F.concat(F.transform("steps", lambda s: F.array(s)),
                    F.when(F.size("steps") > 1, F.array("steps")).otherwise(F.array().cast(f"array<{steps.schema['steps'].dataType.simpleString()}>")))
    each = steps.select("doc_id", "h", "item_id", "item_h", "fold", "n_windows", F.explode(ways).alias("steps"))
    places = F.array_distinct(F.flatten("steps.places"))
    return (each.withColumn("containment", F.size(places) / F.col("n_windows"))
            .withColumn("straight", (F.size("steps") == 1) & (F.col("fold") == 0))
            .filter(F.col("containment") >= threshold).drop("n_windows").distinct())


def _judged(docs: DataFrame, benchmark: DataFrame, threshold: float) -> DataFrame:
    """doc_id, h (hash of the text), item_id and the figures of every place that
    holds an item with its slots filled consistently."""
    items = materialise(item_templates(benchmark), "items")
    windows = materialise(item_windows(items), "item-windows")
    found = materialise(candidates(docs, windows, threshold), "leaks")
    keys = found.select("doc_id", "h").distinct()
    texts = _rows(docs)
    # only the documents that may hold an item are tokenised again
    mine = (texts.alias("t").join(_bounded(keys).alias("k"), (F.col("t.h") == F.col("k.h"))
                                  & F.col("t.doc_id").eqNullSafe(F.col("k.doc_id")), "left_semi")
            .dropDuplicates(["doc_id", "h"]).withColumn("draw", raw_tokens("text")))
    mine = mine.select("doc_id", "h", F.posexplode(_readings("draw")).alias("fold", "draw"))
    mine = mine.withColumn("dtpl", _template(F.col("draw")))
    both = (found.alias("f").join(mine.alias("m"), (F.col("f.h") == F.col("m.h")) & (F.col("f.fold") == F.col("m.fold"))
                                  & F.col("f.doc_id").eqNullSafe(F.col("m.doc_id")))
            .select("f.*", "m.draw", "m.dtpl")
            .join(items.withColumnRenamed("h", "item_h"), ["item_id", "item_h", "fold"]))

    def add(tokens: Column, step: Column) -> Column:
        """Tokens that a step covers and no earlier one does, each with its diagonal."""
        mine = F.array_distinct(F.flatten(F.transform(step["places"], lambda p: F.sequence(p, p + (WINDOW - 1)))))
        new = F.array_except(mine, F.transform(tokens, lambda t: t["i"]))
        return F.concat(tokens, F.transform(new, lambda i: F.struct(i.alias("i"), step["diag"].alias("diag"))))

    covered = F.aggregate("steps", F.array().cast("array<struct<i:int,diag:int>>"), add)
    last_word = r"^.* "  # of a run of capitals, what stands beside the passage may have joined it
    pairs = F.transform(
        F.filter(covered, lambda c: F.get("tpl", c["i"]).startswith("<")
                 & (F.get("tpl", c["i"]) == F.get("dtpl", c["i"] + c["diag"]))),
        lambda c: F.struct(F.get("tpl", c["i"]).alias("kind"), F.regexp_replace(F.get("raw", c["i"]), last_word, "").alias("a"),
                           F.regexp_replace(F.get("draw", c["i"] + c["diag"]), last_word, "").alias("b")))
    judged = both.withColumn("pairs", F.array_distinct(pairs))
    values = F.array_distinct(F.transform("pairs", lambda p: F.struct(p["kind"], p["a"])))
    consistency = F.when(F.size("pairs") == 0, 1.0).otherwise(F.size(values) / F.size("pairs"))
    return judged.select("doc_id", "h", "item_id", "straight", "containment", F.size("pairs").alias("n_slots"),
                         consistency.alias("slot_consistency")).filter(F.col("slot_consistency") >= threshold)


def contaminated(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """docs (doc_id, text), benchmark (item_id, text) -> doc_id, item_id,
    containment, n_slots, slot_consistency: each document and item found in it.

    Of several places the best counts; places on one diagonal of the text as it
    stands come first. Texts or items that are null, empty or
    shorter than a window, and items without an informative window, match
    nothing. Rows equal in doc_id and text are one document; equal benchmark
    rows are one item. A null doc_id is reported as null. Columns other than
    those named are not read.
    """
    judged = _judged(docs, benchmark, threshold)
    best = F.max(F.struct("straight", "containment", "slot_consistency", "n_slots")).alias("b")
    return judged.groupBy("doc_id", "item_id").agg(best).select(
        "doc_id", "item_id", "b.containment", F.col("b.n_slots").cast("long").alias("n_slots"), "b.slot_consistency")


def clean(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` in which no benchmark item was found. Rows are told
    apart by doc_id and text, so a clean text stays beside a dirty one of its id."""
    dirty = materialise(_judged(docs, benchmark, threshold).select("doc_id", "h").distinct(), "dirty")
    dirty = dirty.select(F.col("doc_id").alias("_dirty"), F.col("h").alias("_dirty_h"))
    return docs.join(_bounded(dirty), (F.xxhash64(docs["text"]) == dirty["_dirty_h"])
                     & docs["doc_id"].cast("long").eqNullSafe(dirty["_dirty"]), "left_anti")
