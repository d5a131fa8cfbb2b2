"""Fuzzy line deduplication with DataFrame functions only: shingle minima, banding, exact Jaccard, union-find.

A line's shingles are its runs of ``SHINGLE`` UTF-16 units. All of them are hashed; the signature has, for each of MINIMA
constants, the hash that is nearest to it by exclusive or. Bands are triples of minima, of which two never share a pair
(``TRIPLES``), so 12 minima give 20 bands. Candidates are verified on all shingles of both lines.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import components, drop, hot_keys, lookup, small, stage

SHINGLE, MINIMA = 8, 12
#: Parts in which bands are shuffled, one after another, so that the disk holds one part at a time.
PARTS = 4
#: Shingles hashed in one row of generated code.
CHUNK = 8
#: Tables of at most so many rows, of a few longs each, are broadcast.
FEW = 250_000
#: Words of 64 marks in a row of a table of marks (a power of two).
MARKS = 16
#: Lines of one side of a block in the last search, about; a line is some 400 bytes there, however long it is.
BLOCK_ROWS = 512
#: Longs of a bitmap (a power of two).
WORDS = 32


def signed(x: int) -> int:
    """The signed 64-bit number of the same bits."""
    return (x + 2**63) % 2**64 - 2**63


#: Evenly spread numbers of 64 bits: multiples of the golden ratio.
NEAREST_TO = [signed((j + 1) * 0x9E3779B97F4A7C15 % 2**64) for j in range(MINIMA)]
#: The cyclic Steiner triple system of order 13 without its last point.
TRIPLES = [t for i in range(13) for t in ((i, (i + 1) % 13, (i + 4) % 13), (i, (i + 2) % 13, (i + 7) % 13)) if 12 not in t]


def shingles(line: Column) -> Column:
    """The distinct 64-bit hashes of a line's runs of SHINGLE units; a line shorter than that is one run."""

    def runs(units: Column) -> Column:
        last = F.greatest(F.octet_length(units) - (2 * SHINGLE - 1), F.lit(1))
        return F.transform(F.sequence(F.lit(1), last, F.lit(2)), lambda i: F.xxhash64(F.substring(units, i, F.lit(2 * SHINGLE))))

    return F.array_distinct(_let(F.encode(line, "UTF-16BE"), runs))


def _hashed(lines: DataFrame) -> DataFrame:
    """Rows of CHUNK shingle hashes (h0, h1, ...; the last shingle fills up), with node and n, the line's number of shingles."""
    units = lines.select("node", F.encode("line", "UTF-16BE").alias("units"))
    units = units.select("node", "units", F.greatest(F.octet_length("units") - (2 * SHINGLE - 1), F.lit(1)).alias("last"))
    chunks = units.select("node", "units", "last", F.explode(F.sequence(F.lit(1), F.col("last"), F.lit(2 * CHUNK))).alias("i"))
    run = [F.substring(F.col("units"), F.least(F.col("i") + 2 * k, F.col("last")) if k else F.col("i"), F.lit(2 * SHINGLE)) for k in range(CHUNK)]
    return chunks.select("node", F.shiftright(F.col("last") + 1, 1).alias("n"), *[F.xxhash64(r).alias(f"h{k}") for k, r in enumerate(run)])


def _signatures(lines: DataFrame) -> DataFrame:
    """node and its ``minima``, for lines (node, line) whose partitioning by node saves the aggregation its shuffle.

    Of hashes and constants the upper halves are compared, which the shuffle packs better: three of them tell bands
    apart, and candidates are verified anyway.
    """
    halves = _hashed(lines).select("node", *[F.shiftright(f"h{k}", 32).cast("int").alias(f"h{k}") for k in range(CHUNK)])
    minima = [F.min(F.least(*[F.col(f"h{k}").bitwiseXOR(F.lit(c >> 32).cast("int")) for k in range(CHUNK)])).alias(f"m{j}") for j, c in enumerate(NEAREST_TO)]
    return halves.groupBy("node").agg(*minima).select("node", F.array(*[f"m{j}" for j in range(MINIMA)]).alias("minima"))


def _bitmaps(lines: DataFrame) -> DataFrame:
    """node, n (shingles, repeats included) and ``seen``: WORDS longs with the bit of each shingle's hash set.

    A bit that one line has and another has not stands for a shingle that only one of them has.
    """
    def word(j: int) -> Column:
        bits = [F.when(F.col(f"w{k}") == j, F.col(f"b{k}")).otherwise(F.lit(0).cast("long")) for k in range(CHUNK)]
        return F.bit_or(reduce(lambda x, y: x.bitwiseOR(y), bits)).alias(f"s{j}")

    placed = [x for k in range(CHUNK) for x in (F.expr(f"shiftleft(1L, cast(h{k} & 63 as int))").alias(f"b{k}"), F.expr(f"(h{k} >> 6) & {WORDS - 1}").alias(f"w{k}"))]
    rows = _hashed(lines).select("node", "n", *placed)
    return rows.groupBy("node").agg(F.first("n").alias("n"), *[word(j) for j in range(WORDS)]).select("node", "n", F.array(*[f"s{j}" for j in range(WORDS)]).alias("seen"))


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """The body with a value that is evaluated once, where lambdas would else evaluate it again and again."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _possible(n_a: Column, seen_a: Column, n_b: Column, seen_b: Column, percent: int) -> Column:
    """False for pairs that cannot be ``percent`` alike: their bitmaps differ in more bits than such lines in shingles."""
    differ = reduce(lambda x, y: x + y, (F.bit_count(F.get(seen_a, F.lit(j)).bitwiseXOR(F.get(seen_b, F.lit(j)))) for j in range(WORDS)))
    return (100 + percent) * differ <= (100 - percent) * (n_a + n_b)


def bands(minima: Column, part: int | None = None) -> Column:
    """The bands of a signature, or one of PARTS parts of them."""
    own = [n for n in range(len(TRIPLES)) if part is None or n * PARTS // len(TRIPLES) == part]
    return F.array(*[F.xxhash64(F.lit(n), *[minima[j] for j in TRIPLES[n]]) for n in own])


def _exploded(docs: DataFrame, own: list[str]) -> DataFrame:
    """doc_id, line_no (from 0), line, and line_key (null for lines of white space only)."""
    lines = docs.select("doc_id", *own, F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    return lines.withColumn("line_key", F.when(F.col("line").rlike(r"[^\s]"), F.unhex(F.md5(F.col("line").cast("binary")))))


def _marked(rows: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Rows whose key, a line's number, is in the first column of ``ids``: by marks of a bit a line, so that wide rows need no shuffle.

    Line numbers are dense within a file, so a row of marks stands for 64 * MARKS lines; FEW such rows are broadcast.
    """
    name = ids.columns[0]
    word = [F.bit_or(F.when(F.expr(f"(`{name}` >> 6) & {MARKS - 1}") == j, F.expr(f"shiftleft(1L, cast(`{name}` & 63 as int))")).otherwise(F.lit(0).cast("long"))) for j in range(MARKS)]
    bits = (64 * MARKS).bit_length() - 1
    pages = ids.groupBy(F.expr(f"`{name}` >> {bits}").alias("_page")).agg(*[w.alias(f"w{j}") for j, w in enumerate(word)])
    pages = stage(pages.select("_page", F.array(*[f"w{j}" for j in range(MARKS)]).alias("_words")), "merge")
    paged = rows.withColumn("_page", F.expr(f"`{key}` >> {bits}"))
    met = paged.join(F.broadcast(pages) if small(pages, 16 * FEW) or pages.limit(FEW + 1).count() <= FEW else pages.hint("merge"), "_page")
    hit = F.expr(f"getbit(get(_words, cast((`{key}` >> 6) & {MARKS - 1} as int)), cast(`{key}` & 63 as int)) = 1")
    return met.where(hit).select(*rows.columns)


def _close(facts: DataFrame, pairs: DataFrame, percent: int) -> DataFrame:
    """Pairs (x, c) with possible: whether their bitmaps leave it open that they are ``percent`` alike."""
    of_x, of_c = _marked(facts, pairs.select("x"), "node"), _marked(facts, pairs.select("c"), "node")
    sized = pairs.join(of_x.select(F.col("node").alias("x"), F.col("n").alias("n_x"), F.col("seen").alias("seen_x")).hint("merge"), "x")
    hot = hot_keys(pairs.groupBy("c").count(), "c", pairs.count())
    sized = lookup(sized, of_c.select(F.col("node").alias("c"), F.col("n").alias("n_c"), F.col("seen").alias("seen_c")), "c", hot=hot)
    return stage(sized.select("x", "c", _possible(F.col("n_x"), F.col("seen_x"), F.col("n_c"), F.col("seen_c"), percent).alias("possible")), "merge")


def _linked(texts: DataFrame, close: DataFrame, percent: int) -> DataFrame:
    """Those pairs (x, c) with 100 * |A & B| >= percent * |A | B| for the sets of 64-bit hashes of all shingles of the two lines.

    The text of a c with many partners goes to several groups, each with a share of them.
    """
    counted = stage(close.groupBy("c").count().withColumn("ways", F.ceil(F.col("count") / 64).cast("int")), "merge")
    texts_x, texts_c = _marked(texts, close.select("x"), "node"), _marked(texts, counted.select("c"), "node")
    spread = lookup(close, counted.select("c", "ways"), "c").withColumn("salt", F.pmod(F.xxhash64("x"), "ways").cast("int"))
    left = spread.select("x", "c", "salt").join(texts_x.select(F.col("node").alias("x"), F.col("line").alias("a")).hint("merge"), "x")
    centers = counted.select("c", F.explode(F.sequence(F.lit(0), F.col("ways") - 1)).alias("salt"))
    right = centers.join(texts_c.select(F.col("node").alias("c"), F.col("line").alias("b")).hint("merge"), "c")
    both = left.join(right.hint("merge"), ["c", "salt"])
    both = both.select("x", "c", shingles(F.col("a")).alias("a"), shingles(F.col("b")).alias("b"))
    both = both.withColumn("shared", F.size(F.array_intersect("a", "b")))
    linked = 100 * F.col("shared") >= percent * (F.size("a") + F.size("b") - F.col("shared"))
    out = stage(both.select("x", "c", linked.alias("linked")), "deal")
    drop(counted)
    return out.where("linked").select("x", "c")


def line_classes(docs: DataFrame, percent: int = 80, row: str | None = None) -> DataFrame:
    """Classes of alike lines in ``docs`` (doc_id long, text string): one row per line of every text.

    Returns doc_id, line_no, first_doc_id, first_line_no, kept. Two lines are linked if they are equal or their sets of
    character shingles have a Jaccard similarity of ``percent`` or more; a class is a component of links; its first line
    by (doc_id, line_no) is kept. Lines are what line feeds separate; lines of white space only are kept and not
    compared. A null text has no lines; an empty one has one empty line.

    Equal lines are merged before anything else. Members of a bucket are compared with its smallest line; then lines
    outside their bucket's largest component meet all its lines of other components. A pair at 80 % misses all bands
    about once in 650 times, one at 85 % once in 4,000, short lines less often.

    Rows that share a doc_id have lines of their own, and of a class one line stays, whichever rows it is in; with
    ``row``, the name of a column that tells rows apart, that is returned as well. Lines of a null doc_id are compared,
    but all kept.
    """
    own = [row] if row else []
    found = stage(_exploded(docs, own).withColumn("at", F.monotonically_increasing_id()), codec="zstd")
    named = found.where("line_key is not null")
    lines = stage(named.groupBy("line_key").agg(F.min("at").alias("node"), F.count("*").alias("count")))
    hot_lines = hot_keys(lines, "line_key", found.count())
    reps = stage(_signatures(_marked(found.select(F.col("at").alias("node"), "line"), lines.select("node"), "node")))
    buckets = None
    for part in range(PARTS):
        spread = reps.select(F.col("node").alias("x"), F.explode(bands(F.col("minima"), part)).alias("bucket"))
        met = spread.repartition("bucket").groupBy("bucket").agg(F.min("x").alias("c"), F.max("x").alias("d"), F.bit_xor("x").alias("e"), F.count("*").alias("count"))
        met = stage(met.where("count > 1"))
        buckets = met if buckets is None else buckets.unionByName(met)
    two = buckets.where("count = 2").select(F.col("d").alias("x"), "c")
    three = buckets.where("count = 3").select("c", "d", F.col("c").bitwiseXOR(F.col("d")).bitwiseXOR(F.col("e")).alias("e"))
    large = buckets.where("count > 3").select("bucket", "c", "count")
    spread = reps.select(F.col("node").alias("x"), F.posexplode(bands(F.col("minima"))).alias("band", "bucket"))
    n_large, in_large = large.agg(F.count("*"), F.coalesce(F.sum("count"), F.lit(0))).first()
    hot = hot_keys(large, "bucket", in_large)
    large = large.select("bucket", "c")
    members = stage(spread.join(F.broadcast(large), "bucket") if n_large <= FEW else lookup(spread, large, "bucket", hot=hot), "merge")
    members = members.select("bucket", "band", "x", "c")
    of_three = three.select("c", F.explode(F.array("d", "e")).alias("x")).select("x", "c")
    pairs = two.unionByName(of_three).unionByName(members.where("x <> c").select("x", "c")).distinct()
    pairs = stage(pairs)
    wanted = stage(pairs.select(F.explode(F.array("x", "c")).alias("node")).distinct(), "merge")
    texts = stage(_marked(found.select(F.col("at").alias("node"), "line"), wanted, "node"), codec="zstd")
    slim = stage(found.select("doc_id", *own, "line_no", "line_key", "at"), codec="zstd")
    drop(found)
    all_reps, reps = reps, stage(_marked(reps, wanted, "node"))
    drop(all_reps)
    facts = stage(_bitmaps(texts))

    roots = None
    if not pairs.isEmpty():
        links = _linked(texts, _close(facts, pairs, percent).where("possible").select("x", "c"), percent).select(F.col("x").alias("a"), F.col("c").alias("b"))
        roots = components(links)
        more = _still_close(members, three, pairs, roots, reps, facts, percent, hot)
        if more is not None:
            roots = components(links.unionByName(_linked(texts, more, percent).select(F.col("x").alias("a"), F.col("c").alias("b"))))
    classes = lines.where("count > 1") if roots is None else lines.join(roots, "node", "left").where("count > 1 or root is not null")
    root = F.col("node") if roots is None else F.coalesce("root", "node")
    classes = stage(classes.select("line_key", root.alias("root")))
    drop(lines, texts, facts, reps, members)
    rooted = stage(lookup(slim, classes, "line_key", "left", hot=hot_lines).select("doc_id", *own, "line_no", "at", "root"))
    drop(slim, classes)
    heads = rooted.where("root is not null and doc_id is not null").groupBy("root").agg(F.min(F.struct("doc_id", "line_no", "at")).alias("first"))
    out = lookup(rooted, stage(heads), "root", "left")
    here = F.struct("doc_id", "line_no", "at")
    first = F.when(F.col("doc_id").isNull() | F.col("first").isNull(), here).otherwise(F.col("first"))
    out = out.select("doc_id", *own, "line_no", first.alias("first"), (first["at"] == F.col("at")).alias("kept"))
    return out.select("doc_id", *own, "line_no", F.col("first.doc_id").alias("first_doc_id"), F.col("first.line_no").alias("first_line_no"), "kept")


def _third_sides(three: DataFrame, roots: DataFrame) -> DataFrame:
    """Pairs (x, c) of the two lines of buckets of three that their star did not compare, where components differ."""
    sides = three.select(F.least("d", "e").alias("c"), F.greatest("d", "e").alias("x")).distinct()
    for end in ("c", "x"):
        sides = sides.join(roots.select(F.col("node").alias(end), F.col("root").alias(f"root_{end}")).hint("merge"), end, "left")
    return stage(sides.where(F.coalesce("root_c", "c") != F.coalesce("root_x", "x")).select("x", "c"), "merge")


def _placed(there: DataFrame) -> DataFrame:
    """Lines with their block: n_rest blocks of lines that are apart; the others fill up the last of these and the rest of n_all."""
    own = F.xxhash64("x")
    block = F.when(F.col("apart"), F.pmod(own, "n_rest")).otherwise(F.col("n_rest") - 1 + F.pmod(own, F.col("n_all") - F.col("n_rest") + 1))
    return there.withColumn("block", block.cast("int"))


def _dealt(there: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both sides of the join of blocks i and j of a bucket, i <= j: lines that are apart, and all lines."""

    def side(lines: DataFrame, own: str, other: str, first: Column, last: Column) -> DataFrame:
        dealt = lines.withColumn(own, F.col("block")).withColumn(other, F.explode(F.sequence(first, last)))
        return dealt.select("bucket", "i", "j", "band", "x", "root", "apart")

    a = side(there.where("apart"), "i", "j", F.col("block"), F.col("n_all") - 1)
    return a, side(there, "j", "i", F.lit(0), F.least(F.col("block"), F.col("n_rest") - 1))


def _still_close(members: DataFrame, three: DataFrame, tried: DataFrame, roots: DataFrame, reps: DataFrame, facts: DataFrame, percent: int, hot: list) -> DataFrame | None:
    """Pairs (x, c) that share a bucket, are in different components, were not tried and may be alike; None if there are none.

    Any link that the stars have not found is one of these. Lines outside their bucket's largest component (``apart``)
    meet all its lines in a join within blocks of about BLOCK_ROWS lines a side, where generated code leaves the pairs
    whose bitmaps are close. Two blocks of lines that are apart meet once, not from both sides; the bucket's smallest line
    is in no block, and any pair is left in the first band that it shares only. Rows hold bitmaps and minima, no texts.
    """
    rooted = lookup(members, roots.select(F.col("node").alias("x"), "root"), "x", "left", hot=[]).withColumn("root", F.coalesce("root", "x"))
    rooted = stage(rooted.select("bucket", "band", "x", "root", (F.col("x") == F.col("c")).alias("center")), "merge")
    sizes = rooted.groupBy("bucket", "root").agg(F.count("*").alias("n"), F.sum((~F.col("center")).cast("long")).alias("own"))
    main = sizes.groupBy("bucket").agg(F.max_by(F.struct("root", "own"), F.struct("n", "root")).alias("main"), F.sum("own").alias("lines"))
    ways = [F.ceil(n / BLOCK_ROWS).cast("int").alias(name) for n, name in ((F.col("lines") - F.col("main.own"), "n_rest"), (F.col("lines"), "n_all"))]
    grid = stage(main.select("bucket", F.col("main.root").alias("main"), *ways).where("n_rest > 0"), "merge")
    there = lookup(rooted, grid, "bucket", hot=hot).withColumn("apart", F.col("root") != F.col("main")).where("not center").drop("center", "main")
    there = stage(_placed(there), "merge")
    asked = there.select(F.col("x").alias("node"))
    known = _marked(facts, asked, "node").join(_marked(reps, asked, "node").hint("merge"), "node")
    words = [F.coalesce(F.get("seen", F.lit(j)), F.lit(0).cast("long")).alias(f"s{j}") for j in range(WORDS)]
    known = stage(known.select(F.col("node").alias("x"), "n", *words, *[F.coalesce(F.get("minima", F.lit(j)), F.lit(0)).alias(f"m{j}") for j in range(MINIMA)]))

    def full(side: DataFrame) -> DataFrame:
        met = side.join(known.hint("merge"), "x")
        words = [F.coalesce(c, F.lit(0).cast(kind)).alias(c) for c, kind in met.dtypes if c not in ("bucket", "i", "j", "apart")]
        return met.select("bucket", "i", "j", F.coalesce("apart", F.lit(False)).alias("apart"), *words)

    a, b = (full(side).alias(name) for side, name in zip(_dealt(there), "ab", strict=True))
    differ = [F.bit_count(F.col(f"a.s{j}").bitwiseXOR(F.col(f"b.s{j}"))) for j in range(WORDS)]
    most = (100 - percent) * (F.col("a.n") + F.col("b.n"))
    few, all_words = ((100 + percent) * reduce(lambda x, y: x + y, d) <= most for d in (differ[: WORDS // 4], differ))
    before = [reduce(lambda x, y: x & y, [F.col("a.band") > n, *[F.col(f"a.m{j}") == F.col(f"b.m{j}") for j in t]]) for n, t in enumerate(TRIPLES)]
    unlike = F.when((F.col("a.i") == F.col("a.j")) & F.col("b.apart"), F.col("a.root") < F.col("b.root")).otherwise(F.col("a.root") != F.col("b.root"))
    met = (F.col("a.bucket") == F.col("b.bucket")) & (F.col("a.i") == F.col("b.i")) & (F.col("a.j") == F.col("b.j"))
    found = a.hint("merge").join(b, met & unlike & few & all_words & ~reduce(lambda x, y: x | y, before))
    found = stage(found.select(F.greatest("a.x", "b.x").alias("x"), F.least("a.x", "b.x").alias("c")), "merge")
    sides = _third_sides(three, roots)
    if not sides.isEmpty():
        found = found.unionByName(_close(facts, sides, percent).where("possible").select("x", "c"))
    found = stage(found.distinct().join(tried.select("x", "c"), ["x", "c"], "left_anti"), "merge")
    drop(known, there, rooted)
    return None if found.isEmpty() else found


def deduplicated(docs: DataFrame, **options) -> DataFrame:
    """``docs`` without the lines that are not kept, with n_chars (if there is one) set anew; other columns stay.

    A row that had text and loses every line that is not white space goes; all its lines are kept elsewhere. Rows are
    told apart by a number of their own, so rows that share a doc_id keep what only they have.
    """
    rows = stage(docs.withColumn("_row", F.monotonically_increasing_id()), codec="zstd")
    gone = line_classes(rows, row="_row", **options).where("not kept").groupBy("_row").agg(F.collect_set("line_no").alias("_gone"))
    left = rows.join(gone.hint("merge"), "_row", "left")
    rest = F.filter(F.split("text", "\n"), lambda line, at: ~F.array_contains("_gone", at))
    changed = F.col("_gone").isNotNull()
    left = left.withColumn("text", F.when(changed, F.array_join(rest, "\n")).otherwise(F.col("text")))
    left = left.where(~changed | F.col("text").rlike(r"[^\s]"))
    if "n_chars" in docs.columns:
        left = left.withColumn("n_chars", F.length("text").cast(dict(docs.dtypes)["n_chars"]))
    return left.select(*docs.columns)
