"""Document fingerprints: a Merkle tree over leaves, paragraphs and sections.

A paragraph is a line. Its leaves are its sentences, cut further after words of
``LONG_WORD`` code points or more, and runs without such a place every ``RUN``
code points; cuts look at the text just before them only, so an edit inside a
long sentence changes the leaf around it and leaves the others as they are. A
paragraph's node is the digest of its leaves' digests. Sections are
content-defined: a paragraph whose digest begins with 0-3 (one in four) ends its
section, so an insertion changes the sections it touches and no others. The
root, a SHA-256 over the sections' digests, is the fingerprint: equal texts have
equal ones.

Two trees are compared from the top: sections by their content, the paragraphs
of sections that the other tree lacks, then the leaves of paragraphs that it
lacks, against the leaves of the other tree's own such paragraphs
(``walk``). What is left are the differing branches, returned as ranges of
code points; ``likeness`` is the share of both trees outside them. A branch that
has only moved isn't listed. Comparing takes hashing for sections and
paragraphs, a binary search for a leaf and a scan in log2(leaves) steps for
places, so a very long text costs little more a leaf than a short one.

Native: DataFrame functions only.

To set each document beside the next one by id, ids are cut into ranges at
approximate quantiles, one shuffle deals whole ranges out, and the first
document of each range is also sent to the range before it.

Defined cases: a null text is empty, an empty text has one empty leaf; null
ids come first; equal ids are ordered by text, and each repeated row has the
next row in that order as its next document; a table of one row is followed by
itself; an empty table gives no rows; ids are numbers; other columns are not
read.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Words of so many code points end a leaf, and runs of so many without a cut are cut.
LONG_WORD, RUN = 10, 256
#: Where a leaf ends inside a line: a sentence's end, or a long word's.
LEAF_END = rf"([.!?]+[ \t\r\f]+|[^ \t\r\f]{{{LONG_WORD}}}[ \t\r\f]+)"
_CUT = "\u0001"
#: Arrays of up to 2^25 leaves are searched and summed; so few are searched one by one.
_STEPS, _FEW = [1 << k for k in range(25)], 64


def leaf_lists(text: Column) -> Column:
    """array of paragraphs, each an array of its leaves: digest, dash, code points."""
    def leaves(paragraph):
        cut = F.regexp_replace(F.regexp_replace(paragraph, LEAF_END, "$1" + _CUT), f"([^{_CUT}]{{{RUN}}})", "$1" + _CUT)
        return F.transform(F.split(cut, _CUT), lambda s: F.concat(F.md5(s.cast("binary")), F.lit("-"), F.length(s).cast("string")))

    return F.transform(F.split(text, "\n"), leaves)


def paragraph_digests(tree: Column) -> Column:
    return F.transform(tree, lambda p: F.md5(F.array_join(p, ",").cast("binary")))


def section_lists(paragraphs: Column) -> Column:
    """The sections, each as its paragraphs' digests with a comma after every one."""
    marked = F.regexp_replace(F.concat(F.array_join(paragraphs, ","), F.lit(",")), "([0-3][0-9a-f]{31},)", "$1;")
    return F.filter(F.split(marked, ";"), lambda s: s != "")


def root(sections: Column) -> Column:
    return F.sha2(F.array_join(F.transform(sections, lambda s: F.md5(s.cast("binary"))), ",").cast("binary"), 256)


def with_tree(df: DataFrame, text: str, name: str) -> DataFrame:
    """``df`` with the tree of a text column: three columns, so that none is computed twice."""
    return (df.withColumn(f"{name}_tree", leaf_lists(F.col(text))).withColumn(f"{name}_paragraphs", paragraph_digests(F.col(f"{name}_tree")))
            .withColumn(f"{name}_sections", section_lists(F.col(f"{name}_paragraphs"))))


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)``, with the value computed once, whatever lambdas refer to it."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _member(values: Column, use: Callable[[Callable[[Column], Column]], Column]) -> Column:
    """``use(held)``, where ``held(x)`` tells whether x is one of ``values``: by binary search where these are many."""
    def searching(ordered: Column) -> Column:
        def found(fitting: Column) -> Column:
            def held(x: Column) -> Column:
                low = F.aggregate(fitting, F.lit(0), lambda at, s: F.when(F.get(ordered, at + s - 1) <= x, at + s).otherwise(at))
                return F.when(F.size(ordered) <= _FEW, F.array_contains(ordered, x)).otherwise(F.coalesce(F.get(ordered, low - 1) == x, F.lit(False)))

            return use(held)

        steps = F.array(*[F.lit(s) for s in reversed(_STEPS)])
        return _let(F.filter(steps, lambda s: s <= F.size(ordered)), found)

    return _let(F.when(F.size(values) <= _FEW, values).otherwise(F.sort_array(values)), searching)


def open_paragraphs(name: str, other: str) -> Column:
    """Digests of the paragraphs that the other tree lacks: looked for in sections that it lacks only."""
    missing = F.array_except(f"{name}_sections", f"{other}_sections")
    inside = F.flatten(F.transform(missing, lambda s: F.split(s.substr(F.lit(1), F.length(s) - 1), ",")))
    return F.array_except(inside, F.col(f"{other}_paragraphs"))


def _open_leaves(name: str, opened: str) -> Column:
    """Distinct leaves of a tree's open paragraphs."""
    paired = F.arrays_zip(F.col(f"{name}_tree").alias("t"), F.col(f"{name}_paragraphs").alias("p"))
    return F.when(F.size(opened) == 0, F.array().cast("array<string>")).otherwise(_member(
        F.col(opened), lambda held: F.array_distinct(F.flatten(F.transform(F.filter(paired, lambda z: held(z["p"])), lambda z: z["t"])))))


def walk(df: DataFrame, name: str, other: str, as_name: str) -> DataFrame:
    """Adds ``{as_name}_open``, the open paragraphs of tree ``name`` beside tree ``other``, and ``{as_name}_lost``, the leaves
    of these that the other's open paragraphs lack; with ``{as_name}_other_open`` and ``{as_name}_other_lost`` the other way round."""
    df = df.withColumns({f"{as_name}_open": open_paragraphs(name, other), f"{as_name}_other_open": open_paragraphs(other, name)})
    df = df.withColumns({f"{as_name}_a": _open_leaves(name, f"{as_name}_open"), f"{as_name}_b": _open_leaves(other, f"{as_name}_other_open")})
    return (df.withColumns({f"{as_name}_lost": F.array_except(f"{as_name}_a", f"{as_name}_b"),
                            f"{as_name}_other_lost": F.array_except(f"{as_name}_b", f"{as_name}_a")}).drop(f"{as_name}_a", f"{as_name}_b"))


def leaf_size(leaf: Column) -> Column:
    return F.substring(leaf, 34, 12).cast("int")


def leaves_size(leaves: Column) -> Column:
    return F.aggregate(leaves, F.lit(0).cast("long"), lambda n, leaf: n + leaf_size(leaf))


def likeness(size: Column, other_size: Column, lost: Column, other_lost: Column) -> Column:
    """The share of both trees' leaves (each distinct leaf once, by code points) outside differing branches; 1 for texts without any."""
    total = size + other_size
    return F.when(total == 0, F.lit(1.0)).otherwise(F.lit(1.0) - (leaves_size(lost) + leaves_size(other_lost)) / total)


def marks(name: str, opened: str, lost: str) -> Column:
    """array<struct<n, changed>>: each leaf's code points (a paragraph's last with its line end), and whether it is in a differing branch."""
    tree = F.col(f"{name}_tree")

    def marked(is_open, is_lost):
        def paragraph(z, k):
            def leaf(x, i):
                n = leaf_size(x) + F.when((i == F.size(z["t"]) - 1) & (k < F.size(tree) - 1), 1).otherwise(0)
                return F.struct(n.alias("n"), (z["o"] & is_lost(x)).alias("changed"))

            return F.transform(z["t"], leaf)

        paired = F.zip_with(tree, F.col(f"{name}_paragraphs"), lambda t, p: F.struct(t.alias("t"), is_open(p).alias("o")))
        return F.flatten(F.transform(paired, paragraph))

    return _member(F.col(opened), lambda is_open: _member(F.col(lost), lambda is_lost: marked(is_open, is_lost)))


def ranges_of(marked: Column) -> Column:
    """Differing branches as text ranges, ``start-end`` in code points, neighbours joined."""
    def joined(solid: Column) -> Column:
        # Prefix sums by doubling: log2(leaves) passes over the array.
        ends = F.aggregate(F.array(*[F.lit(s) for s in _STEPS]), F.transform(solid, lambda x: x["n"].cast("long")),
                           lambda acc, s: F.when(s >= F.size(acc), acc).otherwise(
                               F.transform(acc, lambda x, i: x + F.coalesce(F.get(acc, i - s), F.lit(0).cast("long")))))
        edge = lambda x, i, step: x["changed"] & ~F.coalesce(F.get(solid, i + step)["changed"], F.lit(False))

        def spans(end: Column) -> Column:
            starts = F.transform(solid, lambda x, i: F.when(edge(x, i, -1), F.get(end, i) - x["n"]))
            stops = F.transform(solid, lambda x, i: F.when(edge(x, i, 1), F.get(end, i)))
            return F.zip_with(F.filter(starts, lambda x: x.isNotNull()), F.filter(stops, lambda x: x.isNotNull()), lambda a, b: F.concat_ws("-", a, b))

        return _let(ends, spans)

    return F.when(~F.exists(marked, lambda x: x["changed"]), F.lit("")).otherwise(F.array_join(_let(F.filter(marked, lambda x: x["n"] > 0), joined), ","))


def beside_next(docs: DataFrame, ranges: int) -> DataFrame:
    """(id, text, range, extra) dealt out by ranges of ids; ``extra`` rows are the next range's first document, put last."""
    base = docs.select("id", "text")
    quantiles = base.agg(F.percentile_approx("id", [i / ranges for i in range(1, ranges)], F.lit(10_000)).alias("q")).first()["q"] if ranges > 1 else []
    cuts = sorted(set(quantiles or []))
    # Two steps of about sqrt(ranges) comparisons find a row's range.
    step = max(1, math.isqrt(len(cuts)))
    groups = [cuts[i:i + step] for i in range(0, len(cuts), step)] or [[]]
    outer = F.array(*[F.lit(g[0]) for g in groups[1:]]).cast(f"array<{dict(base.dtypes)['id']}>")
    inner = F.array(*[F.array(*[F.lit(x) for x in g]).cast(f"array<{dict(base.dtypes)['id']}>") for g in groups])
    k = F.size(F.filter(outer, lambda x: x <= F.col("id")))
    number = F.coalesce(k * (step + 1) + F.size(F.filter(F.element_at(inner, k + 1), lambda x: x <= F.col("id"))), F.lit(0))
    placed = base.withColumn("range", F.when(F.col("id").isNull(), F.lit(0)).otherwise(number))
    firsts = {r["range"]: (None if r["nulls"] else r["least"]) for r in placed.groupBy("range").agg(
        F.min("id").alias("least"), F.max(F.col("id").isNull()).alias("nulls")).collect()}  # one row a range
    order = sorted(firsts)
    size = (max(order) if order else 0) + 1
    least, before = [None] * size, [0] * size
    for i, r in enumerate(order):
        least[r], before[r] = firsts[r], order[i - 1]
    id_type = dict(base.dtypes)["id"]
    first = F.element_at(F.array(*[F.lit(x).cast(id_type) for x in least]), F.col("range") + 1)
    target = F.element_at(F.array(*[F.lit(x) for x in before]), F.col("range") + 1)
    own = F.struct(F.col("range").alias("range"), F.lit(0).alias("extra"))
    copies = F.when(F.col("id").eqNullSafe(first), F.array(own, F.struct(target.alias("range"), F.lit(1).alias("extra")))).otherwise(F.array(own))
    return (placed.withColumn("place", F.explode(copies)).select("id", "text", F.col("place.range").alias("range"), F.col("place.extra").alias("extra"))
            .repartition(F.col("range")))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a document: its fingerprint, that of its edited text, and how like its tree is to that one's and the next document's.

    ``removed`` and ``added`` are the differing branches of the text and of the
    edited text, as ranges of code points.
    The edited text has its last floor(n/2) code points replaced by the first as
    many (or all) of the next document's.
    """
    spark = docs.sparkSession
    ranges = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    base = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    # The trees are made after the shuffle, so only texts are moved; values that are used twice are columns of their own.
    rows = with_tree(beside_next(base, ranges), "text", "own").withColumn("own_size", leaves_size(F.array_distinct(F.flatten("own_tree"))))
    order = W.partitionBy("range").orderBy("extra", F.col("id").asc_nulls_first(), "text")
    half = F.floor(F.length("text") / 2).cast("int")
    done = (rows.withColumn("next", F.lead(F.struct("text", "own_tree", "own_paragraphs", "own_sections", "own_size")).over(order)).where(F.col("extra") == 0)
            .withColumn("edited", F.concat(F.expr("substring(text, 1, length(text) - cast(floor(length(text) / 2) as int))"),
                                           F.substring(F.col("next")["text"], F.lit(1), half)))
            .withColumns({f"next_{c}": F.col("next")[f"own_{c}"] for c in ("tree", "paragraphs", "sections", "size")}))
    done = with_tree(done, "edited", "edited").withColumn("edited_size", leaves_size(F.array_distinct(F.flatten("edited_tree"))))
    done = walk(walk(done, "own", "edited", "e"), "own", "next", "n")
    done = done.withColumns({"removed": marks("own", "e_open", "e_lost"), "added": marks("edited", "e_other_open", "e_other_lost")})
    return done.select(
        "id", F.length("text").cast("long").alias("n_chars"), F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        root(F.col("own_sections")).alias("fingerprint"), root(F.col("edited_sections")).alias("edited_fingerprint"),
        likeness(F.col("own_size"), F.col("edited_size"), F.col("e_lost"), F.col("e_other_lost")).alias("near_edited"),
        likeness(F.col("own_size"), F.col("next_size"), F.col("n_lost"), F.col("n_other_lost")).alias("near_next"),
        F.size("own_sections").alias("n_sections"), ranges_of(F.col("removed")).alias("removed"), ranges_of(F.col("added")).alias("added"))
