"""Document fingerprints by one-permutation MinHash, in DataFrame functions only.

A text is the set of its runs of five lower-cased words; a text of fewer words is one run, a text without a word has none.
Every run is hashed once: the checksums of its words, each times a factor of its place, modulo a prime of 45 bits. The upper
eight bits choose one of 256 bins, and a bin keeps its smallest hash. An empty bin borrows from the first filled one of its
own fixed order of all bins (the densification of least variance), so any two texts fill their gaps alike. The lowest four
bits of each bin are kept, packed as 256 hexadecimal digits. Two texts agree in a bin by chance with probability 1/16, which
`likeness` takes out again.

Neighbours are found in slices of the descending order of doc_id: bounds of near equal shares are taken from the ids, texts
are shuffled once by slice, and a slice reads on in the first row of the next one.
"""

from __future__ import annotations

import functools
import hashlib

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stayline.llm.tables import read, stored, unused

SHINGLE_WORDS = 5
BINS = 256
#: A kept digit has so many values.
VALUES = 16
#: Places of a bin's order that are looked up in a table; the rest of the order is found by hashing.
TRIES = 16
#: Rows of a slice, while there are fewer than MAX_SLICES of them; then slices grow.
SLICE_ROWS = 2_000
MAX_SLICES = 10_000

#: The largest prime of 45 bits; bits of a hash below those of its bin.
PRIME = 2**45 - 55
VALUE_BITS = 37
_LARGEST = (1 << VALUE_BITS) - 1
_LEAST = -(1 << 63)


def _factors(width: int) -> list[int]:
    """Of each place in a run: 28 bits, so that a sum of `width` products with checksums fits a long up to eight places."""
    if not 1 <= width <= 8:
        raise ValueError("runs have one to eight words")
    return [int(hashlib.md5(f"place {place}".encode()).hexdigest()[:7], 16) for place in range(width)]


def _preference(own: int, other: int) -> str:
    """Bins that an empty bin `own` borrows from come in the order of this hash."""
    return hashlib.md5(f"{own}:{other}".encode()).hexdigest()


@functools.cache
def _first_choices() -> list[list[int]]:
    """For each of TRIES places, the bin that stands there in the order of each bin."""
    orders = [sorted(range(BINS), key=lambda other: _preference(own, other))[:TRIES] for own in range(BINS)]
    return [list(place) for place in zip(*orders, strict=True)]


def _constant(values: list) -> Column:
    """An array that is one node of the plan, however long it is."""
    return F.split(F.lit(",".join(map(str, values))), ",")


def words_of(text: Column) -> Column:
    """Lower-cased words between ASCII white space."""
    signs = "\t\n\x0b\x0c\r"
    return F.array_remove(F.split(F.lower(F.translate(text, signs, " " * len(signs))), " "), "")


def with_fingerprint(rows: DataFrame, source: str, target: str, width: int = SHINGLE_WORDS) -> DataFrame:
    """Add `target`, the fingerprint of the texts in `source`: 256 hexadecimal digits, one of each bin.

    A text without a word has the empty string, a null text null. Equal texts have equal fingerprints.
    """
    sums, hashes, least, bins, filled = (unused(rows, f"_{name}") for name in ("sums", "hashes", "least", "bins", "filled"))
    factors = _factors(width)
    # each column is used more than once by the next, so that the optimizer keeps it as a step of its own
    rows = rows.withColumn(sums, F.transform(words_of(F.col(source)), lambda word: F.crc32(word.cast("binary"))))
    n = F.size(sums)

    def run(first: Column, at: Column, places: int) -> Column:
        total = first * F.lit(factors[0])
        for place in range(1, places):
            total += F.get(sums, at + place) * F.lit(factors[place])
        # never null; said so, as arrays without nulls are sorted faster
        return F.coalesce(total % F.lit(PRIME), F.lit(0).cast("long"))

    runs = F.transform(F.slice(sums, 1, F.greatest(n - width + 1, F.lit(0))), lambda x, at: run(x, at, width))
    for places in range(1, width):
        runs = F.when(n == places, F.array(run(F.get(sums, F.lit(0)), F.lit(0), places))).otherwise(runs)
    # the largest value of every bin stands for an empty one, so that each bin has a first one
    marks = F.sequence(F.lit(_LARGEST), F.lit((BINS << VALUE_BITS) - 1), F.lit(1 << VALUE_BITS))
    rows = rows.withColumn(hashes, F.sort_array(F.concat(runs, marks)))
    bin_of = lambda h: F.shiftright(h, VALUE_BITS)
    rows = rows.withColumn(least, F.filter(hashes, lambda h, at: (at == 0) | (bin_of(h) != bin_of(F.get(hashes, at - 1)))))
    rows = rows.withColumn(bins, F.transform(least, lambda h: F.when(h.bitwiseAND(F.lit(_LARGEST)) != _LARGEST, h)))
    rows = rows.withColumn(filled, F.filter(bins, lambda h: h.isNotNull()))
    tables = [_constant(choices).cast("array<int>") for choices in _first_choices()]

    def densified(h: Column, at: Column) -> Column:
        tried = [F.get(bins, F.get(table, at)) for table in tables]
        ranked = F.transform(filled, lambda x: F.struct(F.md5(F.concat_ws(":", at, bin_of(x)).cast("binary")).alias("by"), x.alias("h")))
        return F.coalesce(h, *tried, F.array_min(ranked)["h"])

    digit = lambda h: F.substring(F.lit("0123456789abcdef"), (h.bitwiseAND(F.lit(VALUES - 1)) + 1).cast("int"), F.lit(1))
    digits = F.when(F.size(filled) > 0, F.array_join(F.transform(bins, lambda h, at: digit(densified(h, at))), ""))
    spoken = F.when(F.col(source).isNotNull(), F.coalesce(digits, F.lit("")))
    columns = [c for c in rows.columns if c not in (sums, hashes, least, bins, filled)]
    return rows.select(*columns, spoken.alias(target))


def likeness(a: Column, b: Column) -> Column:
    """Estimated Jaccard similarity of two fingerprints, from 0 to 1: the share of equal digits less those by chance.

    Two texts without a word are alike, one without and one with words are not.
    """
    equal = F.size(F.filter(F.zip_with(F.split(a, ""), F.split(b, ""), lambda x, y: x == y), lambda same: same))
    corrected = F.greatest(VALUES * equal - BINS, F.lit(0)) / F.lit(float((VALUES - 1) * BINS))
    return F.when((a == "") | (b == ""), (a == b).cast("double")).otherwise(corrected)


def _count_below(bounds: Column, n: int, value: Column, equal: bool) -> Column:
    """How many of `n` ascending bounds are below a value, or not above it."""
    steps = [1 << bit for bit in reversed(range(n.bit_length()))]
    below = (lambda bound: bound <= value) if equal else (lambda bound: bound < value)
    go = lambda at, step: F.when((at + step <= n) & below(F.get(bounds, at + step - 1)), at + step).otherwise(at)
    return F.aggregate(F.array(*[F.lit(step) for step in steps]), F.lit(0), go)


def in_slices(docs: DataFrame, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """doc_id, text (null: empty), and the order `rev`, `mix` with the `slice` of it that a row lies in.

    Descending doc_id, null ids last; rows that share an id follow each other by a hash of text and place in the input. An
    id that holds a large share of all rows spans several slices, which share its rows by that hash.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col("text"), F.lit(""))
    rev = F.bitwise_not(F.coalesce(F.col("doc_id").cast("bigint"), F.lit(_LEAST)))
    rows = docs.select("doc_id", text.alias("text"), rev.alias("rev"), F.xxhash64(text, F.monotonically_increasing_id()).alias("mix"))
    slices = min(MAX_SLICES, -(-docs.count() // slice_rows))
    bounds: list[int] = []
    if slices > 1:
        shares = [number / slices for number in range(1, slices)]
        bounds = docs.select(rev.alias("rev")).agg(F.percentile_approx("rev", shares, max(10_000, 20 * slices))).head()[0]
    if not bounds:
        return rows.withColumn("slice", F.lit(0))
    table = _constant(bounds).cast("array<bigint>")
    low, high = (_count_below(table, len(bounds), F.col("rev"), equal) for equal in (False, True))
    place = F.floor((F.col("mix").cast("double") / 2.0**64 + 0.5) * (F.col("high") - F.col("low") + 1)).cast("int")
    placed = rows.withColumn("low", low).withColumn("high", high)
    return placed.select("doc_id", "text", "rev", "mix", F.least("high", F.col("low") + place).alias("slice"))


def _edited(text: str, following: str) -> Column:
    """The last half of a text, rounded down, gives way to as many code points of the following one."""
    half = F.floor(F.length(text) / 2).cast("int")
    return F.concat(F.substring(F.col(text), F.lit(1), F.length(text) - half), F.substring(F.col(following), F.lit(1), half))


def neighbours(docs: DataFrame, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """Per row of `docs` (doc_id, text): n_chars, edited_sha256, and the fingerprints of its text, of its edited text and of
    the next document (fingerprint, edited_fingerprint, next_fingerprint).

    The next document is that with the next smaller doc_id, null ids being the smallest; after the last comes the first, so
    a single document is its own next. A null text counts as empty. Repeated rows each have a place. An empty table gives
    none. Other columns of `docs` are not looked at.
    """
    inside = Window.partitionBy("slice").orderBy("rev", "mix")
    placed = in_slices(docs, slice_rows).withColumns(
        {"following": F.lead("text").over(inside), "first": F.row_number().over(inside) == 1}
    )
    last = F.col("following").isNull()
    # only texts at the ends of slices are needed again
    rows = with_fingerprint(placed, "text", "fingerprint").select(
        "doc_id", "rev", "mix", "slice", "first", last.alias("last"), F.length("text").cast("bigint").alias("n_chars"), "fingerprint",
        F.when(F.col("first") | last, F.col("text")).alias("text"), _edited("text", "following").alias("edited"),
    )
    rows = with_fingerprint(rows, "edited", "edited_fingerprint").withColumn("edited_sha256", F.sha2(F.col("edited").cast("binary"), 256)).drop("edited")
    rows = stored(rows.withColumn("next_fingerprint", F.lead("fingerprint").over(inside)), "minhash")
    # one small row a slice: which slice comes next
    ordered = Window.orderBy("slice")
    slices = rows.where("first").select("slice", F.lead("slice").over(ordered).alias("after"), F.min("slice").over(Window.partitionBy()).alias("lowest"))
    after = slices.select(F.col("slice").alias("ended"), F.coalesce("after", "lowest").alias("after"))
    firsts = rows.where("first").select(F.col("slice").alias("after"), F.col("text").alias("following"), F.col("fingerprint").alias("next_fingerprint"))
    ends = rows.where("last").drop("edited_fingerprint", "edited_sha256", "next_fingerprint")
    ends = ends.join(after, ends["slice"] == after["ended"]).join(firsts, "after").withColumn("edited", _edited("text", "following"))
    ends = with_fingerprint(ends, "edited", "edited_fingerprint").withColumn("edited_sha256", F.sha2(F.col("edited").cast("binary"), 256))
    columns = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "next_fingerprint"]
    return rows.where("NOT last").select(*columns).unionByName(ends.select(*columns))


def op11_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and their edited texts, and how alike neighbours are."""
    found = neighbours(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"),
    )


ORACLE = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
o AS (
  SELECT doc_id, text, coalesce(lead(text) OVER w, first_value(text) OVER w) AS following
  FROM d WINDOW w AS (ORDER BY doc_id DESC NULLS LAST)),
e AS (SELECT *, left(text, length(text) - length(text) // 2) || left(following, length(text) // 2) AS edited FROM o),
t AS (SELECT text, list_filter(string_split_regex(lower(text), '[ \\t\\n\\x0B\\f\\r]+'), lambda x: x <> '') AS w
  FROM (SELECT text FROM e UNION SELECT edited FROM e)),
steps AS (
  SELECT list(v ORDER BY i) AS steps FROM (SELECT i, list_reduce(list_prepend(i, range(8)),
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v FROM range(256) r(i))),
sums AS (
  SELECT word, xor(list_reduce(list_prepend(4294967295::BIGINT, [('0x' || b)::BIGINT for b in regexp_extract_all(hex(encode(word)), '..')]),
    lambda c, b: xor(c >> 8, steps[(xor(c, b) & 255) + 1])), 4294967295) AS code
  FROM (SELECT DISTINCT unnest(w) AS word FROM t), steps),
coded AS (
  SELECT text, any_value(len(w)) AS n, list(code ORDER BY place) AS c
  FROM (SELECT text, w, unnest(w) AS word, unnest(range(len(w))) AS place FROM t) JOIN sums USING (word) GROUP BY text),
runs AS (
  SELECT text, unnest(list_transform(range(1, greatest(n - 4, 1) + 1), lambda i:
    (TERMS) % PRIME)) AS h FROM coded),
filled AS (SELECT text, h >> 37 AS bin, min(h) AS h FROM runs GROUP BY ALL),
labels AS (SELECT i AS bin FROM range(256) r(i)),
places AS (SELECT text, bin FROM (SELECT DISTINCT text FROM filled), labels),
borrowed AS (
  SELECT p.text, p.bin, arg_min(f.h, md5(p.bin || ':' || f.bin)) AS h
  FROM places p ANTI JOIN filled g ON p.text = g.text AND p.bin = g.bin JOIN filled f ON f.text = p.text GROUP BY ALL),
prints AS (
  SELECT text, string_agg(lower(hex(h & 15)), '' ORDER BY bin) AS print
  FROM (SELECT text, bin, h FROM filled UNION ALL SELECT text, bin, h FROM borrowed) GROUP BY text),
every AS (SELECT t.text, coalesce(print, '') AS print FROM t LEFT JOIN prints USING (text)),
joined AS (
  SELECT doc_id, e.text, edited, a.print AS a, b.print AS b, c.print AS c
  FROM e JOIN every a ON a.text = e.text JOIN every b ON b.text = e.edited JOIN every c ON c.text = e.following),
counted AS (
  SELECT *, len(list_filter(range(1, 257), lambda i: a[i] = b[i])) AS near_b, len(list_filter(range(1, 257), lambda i: a[i] = c[i])) AS near_c FROM joined)
SELECT doc_id, length(text)::BIGINT AS n_chars, sha256(edited) AS edited_sha256, a AS fingerprint, b AS edited_fingerprint,
  CASE WHEN a = '' OR b = '' THEN (a = b)::INT::DOUBLE ELSE greatest(16 * near_b - 256, 0) / 3840.0::DOUBLE END AS near_edited,
  CASE WHEN a = '' OR c = '' THEN (a = c)::INT::DOUBLE ELSE greatest(16 * near_c - 256, 0) / 3840.0::DOUBLE END AS near_next
FROM counted
""".replace("PRIME", str(PRIME)).replace(
    "TERMS", " + ".join(f"coalesce(c[i + {place}], 0) * {factor}" for place, factor in enumerate(_factors(SHINGLE_WORDS)))
)
