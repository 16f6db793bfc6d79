"""Line deduplication by an exact set-similarity join, in DataFrame functions only.

Lines are sets of words; two lines match at a Jaccard similarity of 0.8 or more, and a line goes if an earlier line of the
corpus matches it. Equal lines meet first, by one map-side minimum, so that a line that fills a third of the corpus is one
row afterwards. Then words are ordered by rarity, the rarest fifth (and one) of each line is its prefix, and lines that
share a prefix word are candidates if their lengths, the places of the shared word, and the parities of their words allow the
similarity. There are BANDS parities of 64 bits, each of a share of all words, as one is filled by the words of a long line. Candidates are verified on their whole sets. Every match between two different lines is a link, and all
links are found and counted.

Variants of one line make as many links as there are pairs of them, so these are counted without being listed (`_families`):
a line joins the family of an early line that it matches, and is known by the words in which it differs from most members.
Two members differ by both these sets of words, less twice what the sets share, so all links of a member follow from how many
members have so many differences, and how many share each subset of its own. Members with too many differences for that meet
those that share one of them. Candidates are sought between different families only.

Rarity comes from counts of all words, kept by hash in a table of fixed size; any order gives the same matches, a good one
gives few candidates. Words are compared by 64 bits of their hash.
"""

from __future__ import annotations

from functools import reduce
from math import comb

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stayline.llm.tables import read, release, sized_broadcast, stored, unused, work_path
from stayline.sources.store import scratch

#: Similarity of 4/5 or more; kept as a fraction, so that all bounds are exact.
SIMILAR, OF = 4, 5
#: Counters of the rarity table; a byte each.
RARITY_BITS = 20
_CHUNK_BITS = 10
#: Parities of a line, a power of 2; each is of the words whose hashes fall into one of as many equal parts.
BANDS = 2
PARITIES = [f"parity{at}" for at in range(BANDS)]
#: Keys by which lines look for their families, and lines that must share one; smaller groups are listed pair by pair.
KEYS, CROWD = 3, 8
#: Prefixes of so few words are looked for by single words, too.
SHORT = 3
#: Differences that a member may share with other members, as each subset of them is a row; lines with more meet by difference.
COMMON = 8


def words_of(line: Column) -> Column:
    """Lower-cased words between ASCII white space, and an empty one beside every blank too many."""
    other = [F.contains(line, F.lit(sign)) for sign in "\t\x0b\x0c\r"]
    blanks = F.when(reduce(Column.__or__, other), F.translate(line, "\t\x0b\x0c\r", "    ")).otherwise(line)
    return F.split(F.lower(blanks), " ")


def rarity(texts: DataFrame, bits: int = RARITY_BITS) -> DataFrame:
    """One row with an array of `2 ** bits` bytes: a logarithm of how often words of each hash stand in `texts` (text),
    which are the different lines.

    Counts are summed on the map side, put in chunks side by side, and never gather as words.
    """
    mask = (1 << bits) - 1
    words = texts.select(F.explode(words_of(F.col("text"))).alias("word"))
    counted = words.select(F.xxhash64("word").bitwiseAND(F.lit(mask)).alias("slot"), F.lit(1).cast("long").alias("n"))
    every = texts.sparkSession.range(1 << bits).select(F.col("id").alias("slot"), F.lit(0).cast("long").alias("n"))
    slots = counted.groupBy("slot").agg(F.sum("n").alias("n")).unionByName(every).groupBy("slot").agg(F.sum("n").alias("n"))
    rank = F.least(F.lit(126), F.floor(3 * F.log2(F.col("n") + 1))).cast("tinyint")
    chunk = F.shiftright("slot", _CHUNK_BITS).alias("chunk")
    in_order = lambda name: F.transform(F.array_sort(F.collect_list(name)), lambda x: x["value"])
    chunks = slots.select(chunk, F.struct("slot", rank.alias("value")).alias("part")).groupBy("chunk")
    return (
        chunks.agg(in_order("part").alias("value"))
        .select(F.struct("chunk", "value").alias("part"))
        .agg(F.flatten(in_order("part")).alias("ranks"))
    )


def _first_positions(docs: DataFrame) -> DataFrame:
    """Each different line with a word, and where it stands first: (doc_id, line number, text hash), null ids first."""
    lines = docs.select("doc_id", F.xxhash64("text").alias("code"), F.posexplode(F.split("text", "\n")).alias("number", "line"))
    spoken = lines.where(F.col("line").rlike(r"[^ \x09-\x0D]"))
    return spoken.groupBy("line").agg(F.min(F.struct("doc_id", "number", "code")).alias("first"))


def _hashes(line: Column) -> Column:
    return F.array_remove(F.transform(words_of(line), lambda word: F.xxhash64(word)), F.xxhash64(F.lit("")))


def _heads(lines: DataFrame, ranks: DataFrame, bits: int) -> DataFrame:
    """Per line: id, its number of words n, the parities of its words, and its prefix, rarest word first."""
    mask = (1 << bits) - 1
    one, zero = F.lit(1).cast("long"), F.lit(0).cast("long")

    def code(table: Column, h: Column) -> Column:
        # a rank that cannot be null lets Spark sort plain numbers
        rank = F.coalesce(F.get(table, h.bitwiseAND(F.lit(mask)).cast("int")).cast("long"), zero)
        return F.shiftleft(rank, 56).bitwiseOR(F.shiftrightunsigned(h, 8))

    # the bounds between the bands stand among the sorted words, so that each band is a slice
    bounds = [-(1 << 63) + at * ((1 << 64) // BANDS) for at in range(1, BANDS)]
    marked = F.sort_array(F.concat("words", F.array(*[F.lit(bound).cast("long") for bound in bounds])))
    sets = lines.select("id", F.array_distinct(_hashes(F.col("line"))).alias("words")).withColumn("marked", marked)
    at = [F.lit(0), *[F.array_position("marked", F.lit(bound).cast("long")).cast("int") for bound in bounds], F.size("marked") + 1]
    parities = [
        F.aggregate(
            F.slice("marked", low + 1, high - low - 1), zero,
            lambda seen, h: seen.bitwiseXOR(F.call_function("shiftleft", one, h.bitwiseAND(F.lit(63)).cast("int"))),
        ).alias(name)
        for name, low, high in zip(PARITIES, at, at[1:], strict=False)
    ]
    ordered = F.sort_array(F.array_distinct(F.transform("words", lambda h: code(F.col("ranks"), h))))
    sets = sets.withColumn("ranks", ranks.scalar()).select("id", ordered.alias("words"), *parities)
    n = F.size("words")
    length = n - F.floor((SIMILAR * n + OF - 1) / OF).cast("int") + 1
    return sets.select("id", n.alias("n"), *PARITIES, F.slice("words", F.lit(1), length).alias("prefix"))


def _must_share(total: Column) -> Column:
    """Words that two lines of `total` words together must share to match."""
    return F.floor((SIMILAR * total + SIMILAR + OF - 1) / (SIMILAR + OF)).cast("int")


def _matches(a: Column, b: Column) -> Column:
    """Whether two sets of words are similar."""
    return (SIMILAR + OF) * F.size(F.array_intersect(a, b)) >= SIMILAR * (F.size(a) + F.size(b))


def _keys(heads: DataFrame) -> DataFrame:
    """(id, key): hashes of neighbours in the prefix, the smallest ones, so that variants of a line choose the same."""
    prefix, size, none = F.col("prefix"), F.size("prefix"), F.array().cast("array<bigint>")
    pairs = F.zip_with(F.slice(prefix, F.lit(1), size - 1), F.slice(prefix, F.lit(2), size - 1), lambda x, y: F.xxhash64(x, y))
    alone = F.when(size == 1, F.xxhash64(*PARITIES))  # lines of one prefix word match equal sets only
    singles = F.when(size <= SHORT, F.transform(prefix, lambda word: F.xxhash64(word, "n", alone))).otherwise(none)
    return heads.select("id", F.explode(F.array_distinct(F.concat(F.slice(F.sort_array(pairs), 1, KEYS), singles))).alias("key"))


def _elders(lines: DataFrame, heads: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(elders, sets): an earlier line `elder` that line `id` matches, where one of its crowded keys leads to such a line;
    and the word sets of all lines with crowded keys."""
    keys = _keys(heads)
    crowded = stored(keys.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") >= CROWD).select("key"), "crowded")
    n_crowded = crowded.count()
    rows = stored(keys.join(sized_broadcast(crowded, n_crowded), "key"), "crowded-lines")
    ids = stored(rows.select("id").distinct(), "crowded-ids")
    words = F.array_distinct(_hashes(F.col("line")))
    sets = stored(lines.join(sized_broadcast(ids), "id").select("id", "first", words.alias("words")), "crowded-sets")
    # repeated keys and ids take so few bytes in a file that Spark would broadcast a table of many rows
    places = rows.join(sets.select("id", "first").hint("merge"), "id")
    earliest = places.groupBy("key").agg(F.min(F.struct("first", "id")).alias("e")).select("key", F.col("e.id").alias("elder"))
    tries = stored(
        rows.join(sized_broadcast(earliest, n_crowded), "key").where("id <> elder").select("id", "elder").distinct(), "tries"
    )
    old = sets.join(tries.select(F.col("elder").alias("id")).distinct(), "id").select(
        F.col("id").alias("elder"), F.col("first").alias("elder_first"), F.col("words").alias("elder_words")
    )
    matching = sized_broadcast(tries).join(sets, "id").join(old, "elder").where(_matches(F.col("words"), F.col("elder_words")))
    elders = matching.groupBy("id").agg(F.min(F.struct("elder_first", "elder")).alias("e")).select("id", "e.elder")
    return stored(elders, "elders"), sets


def _rooted(elders: DataFrame) -> DataFrame:
    """(id, family) of lines whose elders end within three steps, and of the lines they end in, which name the families."""
    known = sized_broadcast(elders)
    next_of = lambda n: known.select(F.col("id").alias(f"e{n}"), F.col("elder").alias(f"e{n + 1}"))
    steps = elders.withColumnRenamed("elder", "e1").join(next_of(1), "e1", "left").join(next_of(2), "e2", "left")
    ends = steps.join(next_of(3), "e3", "left").where("e4 IS NULL").select("id", F.coalesce("e3", "e2", "e1").alias("family"))
    return ends.unionByName(ends.select(F.col("family").alias("id"), "family").distinct())


def _between(a: str, b: str) -> Column:
    """Words that stand in one of two sets."""
    return F.array_union(F.array_except(a, b), F.array_except(b, a))


def _differences(members: DataFrame, sets: DataFrame) -> DataFrame:
    """id, family, n (words), d (words in which the line differs from what is usual in its family), and `common`: those of
    them that other members share, as far as links depend on them."""
    roots = sets.join(members.select(F.col("family").alias("id")).distinct(), "id")
    roots = roots.select(F.col("id").alias("family"), F.col("words").alias("root"))
    apart = sized_broadcast(members).join(sets, "id").join(roots, "family")
    apart = stored(apart.select("id", "family", F.size("words").alias("n"), _between("words", "root").alias("differ")), "from-first")
    # what most members have in common is the measure, and not the odd words of the first line
    most = apart.groupBy("family").agg(F.count("*").alias("lines"))
    often = apart.select("family", F.explode("differ").alias("word")).groupBy("family", "word").agg(F.count("*").alias("n"))
    usual = often.join(most, "family").where("2 * n > lines").groupBy("family").agg(F.collect_list("word").alias("usual"))
    rows = apart.join(usual, "family", "left").withColumn("usual", F.coalesce("usual", F.array().cast("array<bigint>")))
    rows = rows.select("id", "family", "n", _between("differ", "usual").alias("differ"))
    rows = stored(rows.withColumn("d", F.size("differ")), "from-usual")
    # two lines whose excesses make no more than 0 match whatever they share, so only words of others count
    excess = rows.withColumn("excess", _excess())
    bounds = excess.groupBy("family").agg(F.max("excess").alias("most"))
    unsure = excess.join(bounds, "family").where("excess + most > 0")
    words = unsure.select("id", "family", "excess", F.explode("differ").alias("word"))
    shared = words.groupBy("family", "word").agg(F.count("*").alias("lines"), F.max("excess").alias("most"))
    # Spark does not count the rows of explode when it sizes a table for a broadcast, here and below
    decisive = words.join(shared.where("lines > 1").hint("merge"), ["family", "word"]).where("excess + most > 0")
    common = decisive.groupBy("id").agg(F.sort_array(F.collect_list("word")).alias("common"))
    known = rows.drop("differ").join(common.hint("merge"), "id", "left")
    return known.withColumn("common", F.coalesce("common", F.array().cast("array<bigint>")))


def _excess() -> Column:
    """Members a and b that share k differences match where a.excess + b.excess <= 2 * (SIMILAR + OF) * k."""
    return (SIMILAR + OF) * F.col("d") - F.col("n")


def _weights() -> list[int]:
    """At u * (COMMON + 2) + m: the sum over t from m to u of (-1) ** (u - t) * comb(u, t)."""
    sums = lambda u, m: sum((-1) ** (u - t) * comb(u, t) for t in range(m, u + 1))
    return [sums(u, m) for u in range(COMMON + 1) for m in range(COMMON + 2)]


def _family_links(rows: DataFrame) -> DataFrame:
    """(id, links): links of each member with at most COMMON shared differences to other such members of its family.

    Members a and b that share k of their differences differ by d = a.d + b.d - 2 * k words, and match where
    (SIMILAR + OF) * d <= a.n + b.n. So each b asks for m shared differences or more, and the number of those that have
    them follows from the numbers of lines that hold each subset of a's differences, by inclusion and exclusion.
    """
    rows = rows.where(F.size("common") <= COMMON)
    subset = lambda mask: F.filter(
        "common", lambda _, at: F.call_function("shiftright", mask, at).bitwiseAND(F.lit(1)) == 1
    )
    masks = F.sequence(F.lit(0), F.call_function("shiftleft", F.lit(1), F.size("common")) - 1)
    subsets = F.transform(masks, lambda mask: F.struct(F.bit_count(mask).alias("u"), F.xxhash64(subset(mask)).alias("code")))
    parts = rows.select("id", "family", "n", "d", F.explode(subsets).alias("s")).select("id", "family", "n", "d", "s.*")
    group = ["family", "u", "code"]
    sizes = parts.groupBy(*group, "n", "d").agg(F.count("*").alias("lines"))
    sizes = sizes.groupBy(*group).agg(F.collect_list(F.struct("n", "d", "lines")).alias("others"))
    weights = F.array(*[F.lit(weight).cast("long") for weight in _weights()])

    def counted(total: Column, other: Column) -> Column:
        over = (SIMILAR + OF) * (F.col("d") + other["d"]) - F.col("n") - other["n"]
        asked = F.greatest(F.lit(0), F.least(F.lit(COMMON + 1), F.ceil(over / F.lit(2.0 * (SIMILAR + OF)))))
        return total + other["lines"] * F.get(weights, (F.col("u") * (COMMON + 2) + asked).cast("int"))

    links = F.aggregate("others", F.lit(0).cast("long"), counted)
    found = parts.join(sizes.hint("merge"), group).groupBy("id").agg(F.sum(links).alias("found"))
    itself = ((SIMILAR + OF) * (F.col("d") - F.size("common")) <= F.col("n")).cast("long")
    return rows.join(found.hint("merge"), "id").select("id", (F.col("found") - itself).alias("links"))


def _links_of_distant(rows: DataFrame) -> DataFrame:
    """(id, links): links between members of which one or both have more than COMMON shared differences, at both ends.

    Links that need no shared difference follow from numbers of members by excess; the others are found by joining such
    members with those that share a difference.
    """
    rows = rows.select("id", "family", _excess().alias("excess"), "common", (F.size("common") > COMMON).alias("many"))
    families = sized_broadcast(stored(rows.where("many").select("family").distinct(), "wide-families"))
    rows = stored(rows.join(families, "family"), "wide-members")
    sizes = rows.groupBy("family", "excess").agg(F.count("*").alias("all"), F.count_if("many").alias("many"))
    others = sizes.groupBy("family").agg(F.collect_list(F.struct("excess", "all", "many")).alias("others"))
    met = F.aggregate(
        "others", F.lit(0).cast("long"),
        lambda total, other: total + F.when(
            F.col("excess") + other["excess"] <= 0, F.when(F.col("many"), other["all"]).otherwise(other["many"])
        ).otherwise(0),
    )
    itself = (F.col("many") & (F.col("excess") <= 0)).cast("long")
    sure = rows.join(sized_broadcast(stored(others, "wide-sizes")), "family").select("id", (met - itself).alias("links"))
    words = rows.select("family", "id", "excess", "many", F.explode("common").alias("word"))
    a = words.where("many").select("family", "word", F.col("id").alias("a"), F.col("excess").alias("a_excess"))
    b = words.select("family", "word", F.col("id").alias("b"), F.col("excess").alias("b_excess"), F.col("many").alias("b_many"))
    over = F.col("a_excess") + F.col("b_excess")
    met = a.join(b.hint("merge"), ["family", "word"]).where((F.col("a") != F.col("b")) & (over > 0))
    shared = met.groupBy("a", "b", "b_many", over.alias("over")).agg(F.count("*").alias("k"))
    linked = shared.where(F.col("over") <= 2 * (SIMILAR + OF) * F.col("k"))
    # two of them meet from both sides
    ends = linked.select(F.explode(F.array_compact(F.array("a", F.when(~F.col("b_many"), F.col("b"))))).alias("id"))
    return sure.unionByName(ends.withColumn("links", F.lit(1).cast("long")))


def _families(lines: DataFrame, heads: DataFrame, path: str) -> DataFrame:
    """(id, family, links) of lines with many variants; stored at `path`. `links` are those inside the family. Each member
    but the one that names the family matches an earlier line."""
    with scratch(lines.sparkSession):
        elders, sets = _elders(lines, heads)
        members = stored(_rooted(elders), "members")
        rows = stored(_differences(members, sets), "differences")
        links = _family_links(rows).unionByName(_links_of_distant(rows)).groupBy("id").agg(F.sum("links").alias("links"))
        found = stored(rows.select("id", "family").join(links, "id"), "families", path)
    release(lines.sparkSession)
    return found


def _candidates(heads: DataFrame, families: DataFrame | None = None) -> DataFrame:
    """Pairs (a, b) of line ids that share a prefix word and pass all bounds, once each; none within a family."""
    columns = ["id", "n", "left", *PARITIES]
    other_family = F.lit(True)
    if families is not None:
        known = heads.join(sized_broadcast(families.select("id", "family")), "id", "left")
        heads = known.withColumn("family", F.coalesce("family", "id"))
        columns.append("family")
        other_family = F.col("a_family") != F.col("b_family")
    kept = [column for column in columns if column != "left"]
    rows = heads.select(*kept, F.posexplode("prefix").alias("place", "word"))
    rows = rows.withColumn("left", F.col("n") - F.col("place"))  # words from the shared one on
    sides = [rows.select("word", *[F.col(c).alias(f"{side}{c}") for c in columns]) for side in ("a_", "b_")]
    total = F.col("a_n") + F.col("b_n")
    lengths = OF * F.least("a_n", "b_n") >= SIMILAR * F.greatest("a_n", "b_n")
    places = (SIMILAR + OF) * F.least("a_left", "b_left") >= SIMILAR * total
    # a bit differs only where the number of words that one line alone holds is odd
    odd = reduce(Column.__add__, [F.bit_count(F.col(f"a_{name}").bitwiseXOR(F.col(f"b_{name}"))) for name in PARITIES])
    parities = odd <= total - 2 * _must_share(total)
    met = sides[0].join(sides[1].hint("merge"), "word")
    return met.where((F.col("a_id") < F.col("b_id")) & other_family & lengths & places & parities).select(
        F.col("a_id").alias("a"), F.col("b_id").alias("b")
    ).distinct()


def _links(lines: DataFrame, pairs: DataFrame) -> DataFrame:
    """(later, earlier) of the pairs that match by their whole sets."""
    involved = stored(pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct(), "involved")
    words = F.array_distinct(_hashes(F.col("line")))
    whole = lines.join(sized_broadcast(involved), "id")
    sets = stored(whole.select("id", words.alias("words"), "first"), "line-sets")
    side = lambda end: sets.select(F.col("id").alias(end), F.struct("words", "first").alias(f"{end}_set"))
    both = pairs.join(side("a"), "a").join(side("b"), "b")
    # a null id comes before all others
    a_later = F.struct("a_set.first", "a") > F.struct("b_set.first", "b")
    return both.where(_matches(F.col("a_set.words"), F.col("b_set.words"))).select(
        F.when(a_later, F.col("a")).otherwise(F.col("b")).alias("later"),
        F.when(a_later, F.col("b")).otherwise(F.col("a")).alias("earlier"),
    )


def line_links(docs: DataFrame, bits: int = RARITY_BITS) -> tuple[DataFrame, DataFrame]:
    """(lines, links): every different line (id, line, first) and all matching pairs (later, earlier) of their ids."""
    lines, links, _ = _linked(docs, bits, by_family=False)
    return lines, links


def _linked(docs: DataFrame, bits: int, by_family: bool) -> tuple[DataFrame, DataFrame, DataFrame | None]:
    """(lines, links, families): as `line_links`; by family, without the links inside families, which are counted there."""
    spark = docs.sparkSession
    texts = docs.select("doc_id", "text").where("text IS NOT NULL")
    lines = stored(_first_positions(texts).select(F.monotonically_increasing_id().alias("id"), "line", "first"), "lines")
    release(spark)
    links, families = work_path(spark, "line-links"), None
    inside = work_path(spark, "families") if by_family else None
    with scratch(spark):  # tables go once the step that reads them is stored
        candidates = work_path(spark, "candidates")
        with scratch(spark):
            ranks = stored(rarity(lines.select(F.col("line").alias("text")), bits), "rarity")
            heads = stored(_heads(lines, ranks, bits), "heads")
            release(spark)
            if inside:
                families = _families(lines, heads, inside)
            pairs = stored(_candidates(heads, families), "candidates", candidates)
        release(spark)
        found = stored(_links(lines, pairs), "line-links", links)
    release(spark)
    return lines, found, families


def kept_lines(docs: DataFrame, bits: int = RARITY_BITS) -> DataFrame:
    """doc_id, code (text hash), kept (numbers of lines that stay) and n_links of documents in which some line stands first.

    n_links counts the links of the lines that stand in the document first, each between two different lines.
    """
    lines, links, families = _linked(docs, bits, by_family=True)
    ends = [F.struct(F.col(end).alias("id"), F.lit(gone).alias("gone")) for end, gone in (("later", 1), ("earlier", 0))]
    counts = links.select(F.explode(F.array(*ends)).alias("e")).select("e.*", F.lit(1).cast("long").alias("links"))
    inside = families.select("id", (F.col("id") != F.col("family")).cast("int").alias("gone"), "links")
    by_line = counts.unionByName(inside).groupBy("id").agg(F.max("gone").alias("gone"), F.sum("links").alias("links"))
    firsts = lines.select("id", "first").join(by_line.hint("merge"), "id", "left")
    stays = F.coalesce("gone", F.lit(0)) == 0
    return firsts.groupBy("first.doc_id", "first.code").agg(
        F.collect_list(F.when(stays, F.col("first.number"))).alias("kept"),
        F.coalesce(F.sum("links"), F.lit(0)).cast("bigint").alias("n_links"),
    )


def _spoken(text: Column) -> Column:
    """Numbers of lines that hold a word."""
    numbered = F.transform(F.split(text, "\n"), lambda line, at: F.when(line.rlike(r"[^ \x09-\x0D]"), at))
    return F.filter(F.coalesce(numbered, F.array().cast("array<int>")), lambda at: at.isNotNull())


def mark_lines(docs: DataFrame, bits: int = RARITY_BITS, prefix: str = "") -> DataFrame:
    """Add to every row of `docs`: n_lines (lines with a word), removed_lines (numbers from 0, ascending) and n_links.

    A line goes if an equal or similar line stands earlier, by doc_id (null first), then line number; so a document
    removes repetitions inside itself too, and equal rows lose the same lines. Where different texts share a doc_id, one
    line of two at the same number counts as earlier. Lines without a word are never removed; null texts have no lines.
    """
    names = {name: unused(docs, prefix + name) for name in ("n_lines", "removed_lines", "n_links")}
    code, spoken = unused(docs, "_code"), unused(docs, "_spoken")
    own = {name: unused(docs, f"_first_{name}") for name in ("doc_id", "code", "kept", "n_links")}
    kept = kept_lines(docs, bits).withColumnsRenamed(own)
    rows = docs.withColumns({code: F.xxhash64("text"), spoken: _spoken(F.col("text"))})
    same = rows["doc_id"].eqNullSafe(kept[own["doc_id"]]) & (rows[code] == kept[own["code"]])
    removed = F.array_except(F.col(spoken), F.coalesce(own["kept"], F.array().cast("array<int>")))
    return rows.join(kept, same, "left").select(
        *[rows[column] for column in docs.columns],
        F.size(spoken).cast("bigint").alias(names["n_lines"]),
        removed.alias(names["removed_lines"]),
        F.coalesce(own["n_links"], F.lit(0)).cast("bigint").alias(names["n_links"]),
    )


def drop_repeated_lines(docs: DataFrame) -> DataFrame:
    """Documents without their removed lines, with all columns; a document that loses every line with a word goes, one
    that had none stays. n_chars, where there is one, follows the text."""
    marks = [unused(docs, "_m_" + name) for name in ("n_lines", "removed_lines", "n_links")]
    marked = mark_lines(docs, prefix="_m_")
    n_lines, removed, _ = (F.col(name) for name in marks)
    left = F.filter(F.transform(F.split("text", "\n"), lambda line, at: F.when(~F.array_contains(removed, at), line)), lambda line: line.isNotNull())
    text = F.when(F.size(removed) > 0, F.array_join(left, "\n")).otherwise(F.col("text"))
    stays = marked.where((n_lines == 0) | (F.size(removed) < n_lines))
    changed = {"text": text}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.when(F.size(removed) > 0, F.length(text).cast("bigint")).otherwise(F.col("n_chars"))
    return stays.select(*[changed.get(column, F.col(column)).alias(column) for column in docs.columns])


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated and similar lines of all documents."""
    marked = mark_lines(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return marked.select(
        "doc_id", "n_lines", F.size("removed_lines").cast("bigint").alias("n_removed"),
        F.array_join("removed_lines", ",").alias("removed_lines"), "n_links",
    )


#: Every pair of lines that shares one of the longest words of the one, compared on whole sets.
ORACLE = """
WITH lines AS (
  SELECT doc_id, unnest(range(0, len(l)))::INT AS number, unnest(l) AS line
  FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents WHERE text IS NOT NULL)),
spoken AS (SELECT * FROM lines WHERE regexp_matches(line, '[^ \\x09-\\x0D]')),
firsts AS (SELECT line, min((doc_id, number)) AS first FROM spoken GROUP BY line),
sets AS (
  SELECT row_number() OVER () AS id, line, first,
    list_distinct([w for w in string_split_regex(lower(line), '[ \\x09-\\x0D]+') if w <> '']) AS words FROM firsts),
longest AS (
  SELECT id, len(words) AS n, unnest((list_sort([(length(w), w) for w in words], 'DESC'))[1:len(words) // 5 + 1]) AS word FROM sets),
every AS (SELECT id, len(words) AS n, unnest(words) AS word FROM sets),
met AS (
  SELECT DISTINCT a.id AS a, b.id AS b FROM longest a JOIN every b ON a.word[2] = b.word AND a.id <> b.id
  WHERE 5 * least(a.n, b.n) >= 4 * greatest(a.n, b.n)),
pairs AS (SELECT DISTINCT least(a, b) AS a, greatest(a, b) AS b FROM met),
links AS (
  SELECT CASE WHEN x.first > y.first THEN a ELSE b END AS later, CASE WHEN x.first > y.first THEN b ELSE a END AS earlier
  FROM pairs JOIN sets x ON x.id = a JOIN sets y ON y.id = b
  WHERE 9 * len(list_intersect(x.words, y.words)) >= 4 * (len(x.words) + len(y.words))),
ends AS (SELECT later AS id FROM links UNION ALL SELECT earlier FROM links),
by_line AS (SELECT id, count(*) AS n FROM ends GROUP BY id),
kept AS (SELECT first[1] AS doc_id, first[2] AS number FROM sets WHERE id NOT IN (SELECT later FROM links)),
linked AS (SELECT first[1] AS doc_id, sum(n) AS n_links FROM sets JOIN by_line USING (id) GROUP BY 1),
marked AS (
  SELECT s.doc_id, s.number, k.number IS NULL AS gone FROM spoken s LEFT JOIN kept k ON s.doc_id = k.doc_id AND s.number = k.number),
by_doc AS (
  SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_removed,
    coalesce(string_agg(number::VARCHAR, ',' ORDER BY number) FILTER (WHERE gone), '') AS removed_lines FROM marked GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_lines, 0)::BIGINT AS n_lines, coalesce(n_removed, 0)::BIGINT AS n_removed,
  coalesce(removed_lines, '') AS removed_lines, coalesce(n_links, 0)::BIGINT AS n_links
FROM documents d LEFT JOIN by_doc USING (doc_id) LEFT JOIN linked USING (doc_id)
"""
