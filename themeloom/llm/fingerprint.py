"""Document fingerprints by consistent weighted sampling, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from themeloom.plans.session import materialise

#: Samples of a fingerprint; the likeness of two has a standard deviation of at most 0.5 / sqrt(SAMPLES).
SAMPLES = 64
#: Samples that one aggregation draws: code for more grows too long for the JIT compiler.
AT_ONCE = 32
#: Documents of one range of ids that are sorted together, and documents whose distinct terms are sampled together.
RANGE, TASK = 256, 1024
#: Cuts of the ids into cells, and of a cell into ranges, at most: so there are at most CUTS ** 2 + CUTS ranges.
CUTS = 400


def _drawn(first: Column, k: int) -> Column:
    """A number whose minimum over the terms (term, log_weight) of a text is its consistent weighted sample first + k.

    A hash of the term and the sample gives three uniform numbers: two make a gamma(2, 1) number r, the third is an
    offset b. The other gamma number c of a sample is the r of its neighbour (2j and 2j + 1 lend each other theirs), so
    that a draw costs two logarithms. With t = floor(ln w / r + b) and ln a = ln c - r * (t - b) - r, the term with
    the least ln a is sampled, along with t. ln a is put into the high 31 bits, in order; below it stand 32 bits of the
    term's own hash, mixed with t.
    """

    def bits(k: int) -> Column:
        return F.xxhash64("term", first + k)

    def uniform(h: Column, shift: int, width: int) -> Column:
        return (F.shiftrightunsigned(h, shift).bitwiseAND(F.lit((1 << width) - 1)) + F.lit(0.5)) / F.lit(float(1 << width))

    def gamma(h: Column) -> Column:
        return -F.log(uniform(h, 43, 21) * uniform(h, 22, 21))

    r, b = gamma(bits(k)), uniform(bits(k), 0, 22)
    t = F.floor(F.col("log_weight") / r + b)
    score = F.greatest(F.lit(-64.0), F.least(F.lit(63.99), F.log(gamma(bits(k ^ 1))) - r * (t - b) - r))
    high = F.shiftleft(F.floor((score + 64.0) * F.lit(float(1 << 24))), 32)
    tag = F.col("term").bitwiseXOR(F.pmod(t, F.lit(65536)) * F.lit(0x9E3779B1))
    return high.bitwiseOR(tag.bitwiseAND(F.lit((1 << 32) - 1)))


def words_of(text: Column) -> Column:
    """Lower-cased words between white space; a text without one has the single word ''."""
    return F.split(F.regexp_replace(F.lower(text), r"^\s+|\s+$", ""), r"\s+")


def fingerprints(rows: DataFrame, part: str, key: str, text: str = "text", samples: int = SAMPLES) -> DataFrame:
    """part, key and fp, an array of samples, for each row of rows(part, key, text); part and key identify a row.

    Terms are words, told apart by 64 bits of hash; they are counted and sampled where their text is: rows that are
    partitioned by part are not shuffled.
    """
    word = rows.select(part, key, F.explode(words_of(F.col(text))).alias("word"))
    terms = word.select(part, key, F.xxhash64("word").alias("term")).groupBy(part, key, "term").agg(F.count("*").alias("weight"))
    firsts = range(0, samples, AT_ONCE)
    drawn = terms.select(part, key, "term", F.log("weight").alias("log_weight"), F.explode(F.array(*[F.lit(k) for k in firsts])).alias("first"))
    low = drawn.groupBy(part, key, "first").agg(*[F.min(_drawn(F.col("first"), k)).alias(f"m{k}") for k in range(AT_ONCE)])
    piece = F.array(*[F.shiftright(F.shiftleft(F.col(f"m{k}"), 32), 32).cast("int") for k in range(AT_ONCE)])
    pieces = low.select(part, key, "first", piece.alias("piece")).groupBy(part, key)
    return pieces.agg(*[F.max(F.when(F.col("first") == k, F.col("piece"))).alias(f"p{k}") for k in firsts]).select(
        part, key, F.concat(*[f"p{k}" for k in firsts]).alias("fp"),
    )


def likeness(a: str, b: str, samples: int = SAMPLES) -> Column:
    """The share of samples in which two fingerprints agree, null if either is."""
    return sum((F.col(a)[k] == F.col(b)[k]).cast("int") for k in range(samples)) / F.lit(float(samples))


def as_text(fp: str, samples: int = SAMPLES) -> Column:
    return F.concat(*[F.lpad(F.hex(F.col(fp)[k].cast("bigint").bitwiseAND(F.lit((1 << 32) - 1))), 8, "0") for k in range(samples)])


def _cuts(values: Column, n: Column) -> Column:
    """About n quantiles of values as an array of ascending numbers, and each frequent value and the number after it."""
    every = F.percentile_approx(values, [k / CUTS for k in range(CUTS)], F.lit(4 * CUTS))
    step = F.greatest(F.lit(1), F.floor(F.lit(CUTS) / n).cast("int"))
    some = F.filter(every, lambda _, i: i % step == 0)
    often = F.filter(every, lambda x, i: (i > 0) & (x == F.get(every, i - 1)))
    after = F.transform(F.filter(often, lambda x: x < F.lit((1 << 63) - 1)), lambda x: x + 1)
    return F.array_sort(F.array_distinct(F.concat(some, often, after)))


def _place(value: Column, cuts: Column) -> Column:
    """How many of the cuts are not above the value."""
    return F.size(F.filter(cuts, lambda c: c <= value))


def placed(docs: DataFrame) -> tuple[DataFrame, int]:
    """docs(doc_id, text) with at and tie, which order the rows, and range; and how many rows there are.

    at is doc_id, or the least number for a null; tie is a hash of the text. Ranges have about RANGE rows (more than that
    where CUTS ** 2 ranges do not suffice): quantiles of `at` cut the rows into cells, and quantiles of `at`, or of
    tie in a cell of a single id, cut a cell. So neither outlying nor repeated ids fill a range (only rows that repeat
    both id and text stay together).
    """
    keyed = docs.withColumns({"at": F.coalesce("doc_id", F.lit(-(1 << 63))), "tie": F.xxhash64("text")})
    n = keyed.count()
    ranges = max(1, -(-n // RANGE))
    outer = max(1, min(CUTS, round(ranges**0.5)))
    first = keyed.agg(_cuts(F.col("at"), F.lit(outer)).alias("c")).first()["c"] or []
    cell = _place(F.col("at"), F.lit(first)) if first else F.lit(0)
    ids = keyed.select("at", "tie", cell.alias("cell"))
    span = ids.groupBy("cell").agg(F.count("*").alias("n"), (F.min("at") == F.max("at")).alias("single"))
    own = F.when(F.col("single"), F.col("tie")).otherwise(F.col("at"))
    inner = F.greatest(F.lit(1), F.least(F.lit(CUTS), F.ceil(F.col("n") / RANGE)))
    cells = materialise(ids.join(F.broadcast(span), "cell").groupBy("cell", "single").agg(_cuts(own, F.first(inner)).alias("cuts")))
    keyed = keyed.withColumn("cell", cell).join(F.broadcast(cells), "cell")
    keyed = keyed.withColumn("range", (F.col("cell") * (2 * CUTS + 2) + _place(own, F.col("cuts"))).cast("bigint"))
    return keyed.select("doc_id", "text", "at", "tie", "range"), n


def with_next(docs: DataFrame) -> DataFrame:
    """docs(doc_id, text) with task, range, row (its number in the task), and after, the text of the next row.

    The least row of a range goes to the range before it as well (that of the first range to the last), with guest 1, so
    a range needs nothing else: every row but that guest has its next row beside it.
    """
    rows, n = placed(docs)
    order = Window.orderBy("range")  # of at most 2 * CUTS ** 2 ranges, one row each
    firsts = rows.groupBy("range").agg(F.min(F.struct("at", "tie")).alias("x"))
    last = F.max("range").over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    firsts = firsts.select("x.at", "x.tie", F.coalesce(F.lag("range").over(order), last).alias("before"))
    guests = rows.join(F.broadcast(firsts), ["at", "tie"]).groupBy("at", "tie", "before").agg(F.min(F.struct("text", "doc_id")).alias("x"))
    guests = guests.select("x.doc_id", "x.text", "at", "tie", F.col("before").alias("range"), F.lit(1).alias("guest"))
    parts = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-n // TASK))
    rows = rows.withColumn("guest", F.lit(0)).unionByName(guests)
    together = TASK // RANGE
    rows = rows.withColumn("task", F.floor(F.col("range") / together)).repartition(parts, "task")
    inside = Window.partitionBy("task", "range").orderBy("guest", "at", "tie", "text", "doc_id")  # with all columns, so that both uses share one shuffle
    number = F.pmod("range", F.lit(together)) * F.lit(1 << 40) + F.row_number().over(inside)
    return rows.withColumns({"row": number, "after": F.lead("text").over(inside)})


def edited_text(text: Column, after: Column) -> Column:
    """The last floor(n/2) code points of text replaced by the first as many (or all) of `after`."""
    n = F.length(text)
    half = F.floor(n / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), n - half), F.substring(after, F.lit(1), half))


def compare_with_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) of each row of docs.

    Null texts are empty; a text without a word has the single term ''. The next document is the next row by doc_id
    (nulls first), then by a hash of the text, and the first row after the last; a single row is its own. Repeated
    rows are rows of their own. No rows give no rows.
    """
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    rows = with_next(rows)
    edited = F.when(F.col("guest") == 0, edited_text(F.col("text"), F.col("after")))
    rows = rows.select("task", "range", "row", "doc_id", "guest", "text", edited.alias("edited"))
    facts = rows.where("guest = 0").select(
        "task", "row", "doc_id", F.length("text").cast("bigint").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
    )
    both = F.array(
        F.struct((F.col("row") * 2).alias("key"), F.col("text").alias("t")),
        F.struct((F.col("row") * 2 + 1).alias("key"), F.col("edited").alias("t")),
    )
    long = rows.select("task", F.explode(both).alias("x")).select("task", "x.key", "x.t").where("t is not null")
    fps = fingerprints(long, "task", "key", "t").select("task", F.shiftright("key", 1).alias("row"), (F.col("key") % 2).alias("which"), "fp")
    one = fps.groupBy("task", "row").agg(*[F.max(F.when(F.col("which") == w, F.col("fp"))).alias(f"fp{w}") for w in (0, 1)])
    one = one.withColumn("fp2", F.lead("fp0").over(Window.partitionBy("task", F.shiftright("row", 40)).orderBy("row")))
    return facts.join(one, ["task", "row"]).select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        as_text("fp0").alias("fingerprint"),
        as_text("fp1").alias("edited_fingerprint"),
        likeness("fp0", "fp1").alias("near_edited"),
        likeness("fp0", "fp2").alias("near_next"),
    )
