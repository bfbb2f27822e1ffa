"""N-gram Jaccard join: documents linked when their word-shingle sets are similar, and the components of links.

Two sets can only be similar if their sizes are; and with shingles in one order for all documents,
they share a shingle among the first ``n - ceil(t * n) + 1`` of each. So a document enters one tile
per such shingle, named by the shingle and by a band of sizes (also the next band, if a partner may
be there). Shingles that are frequent come last in the order, so tiles stay small.

``links`` joins every tile with itself and finds all links. ``join`` looks for components alone: of a
tile's documents each is first compared with the one of smallest id only; most groups of copies
are connected by that. In crowded tiles rounds follow in which each document meets a few others of its tile,
the same for all. Afterwards only tiles that still hold several components are joined with
themselves, across components; a pair is left to an earlier tile that both were seen in shortly before.
In both a pair goes through two steps: a hashed bitmap (each bit the parity
of the shingles that fall on it) bounds the overlap from above, since every differing bit needs a
shingle of one side only; what passes is decided by the exact intersection of the sorted sets.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cadenza.llm.common import may_be_among, per_row, plain, stored, text_slices
from cadenza.llm.components import components
from cadenza.llm.words import U, mix, shingle_sets

# Longs of the brief bitmap, which all documents have in one width and tiles are joined by.
BRIEF_LONGS = 8
# Frequent shingles are put last in the order. That changes the work, never the result: shingles are
# counted in pieces of so many, those seen at least so often in a piece are added up, and so
# many of the most frequent ones are kept (the size of the broadcast).
PIECE = 1 << 21
PIECE_COUNT = 2
FREQUENT = 1 << 20
# Tiles of more sets than this are crowded: in each of at most so many rounds a set there is compared with so many
# others at most. That changes the work only: what the rounds leave apart is joined across components.
CROWD = 16
ROUNDS = 3
MET = 8
# So many tiles of a set before each of its tiles tell whether a pair was met there.
EARLIER = 4


@dataclass(frozen=True)
class Similarity:
    """Jaccard at least ``num / den`` over shingles of ``n`` words."""

    n: int = 5
    num: int = 8
    den: int = 10

    def similar(self, shared: int, a: int, b: int) -> bool:
        return self.den * shared >= self.num * (a + b - shared)

    def prefix(self, size: int) -> int:
        return size - -(-self.num * size // self.den) + 1

    def upper_ends(self, size: int) -> np.ndarray:
        """Greatest size of each band up to the band of ``size``; a band spans four times the allowed ratio."""
        ends, low = [], 1
        while not ends or ends[-1] < size:
            ends.append(max(low, low * self.den**4 // self.num**4))
            low = ends[-1] + 1
        return np.array(ends)

    def possible(self, a: Column, b: Column, differing: Column) -> Column:
        """Whether sizes ``a`` and ``b`` and the number of differing bits allow similarity."""
        # At most (a + b - differing) / 2 shingles are shared.
        return (self.den * a >= self.num * b) & (self.den * b >= self.num * a) & (
            (self.den + self.num) * (a + b - differing) >= 2 * self.num * (a + b)
        )


def frequent_shingles(docs: DataFrame, rule: Similarity) -> tuple[np.ndarray, np.ndarray]:
    """Hashes, in ascending order, and counts of the most frequent shingles over all documents."""

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        waiting: list[np.ndarray] = []
        size = 0

        def counted() -> pd.DataFrame:
            h, n = np.unique(np.concatenate(waiting) if waiting else np.zeros(0, np.uint64), return_counts=True)
            often = n >= PIECE_COUNT
            return pd.DataFrame({"h": h[often].view(np.int64), "n": n[often]})

        for part in text_slices(frames):
            for own in shingle_sets(part["text"].tolist(), rule.n):
                waiting.append(own)
                size += len(own)
            if size >= PIECE:
                yield counted()
                waiting, size = [], 0
        yield counted()

    counts = docs.select("text").mapInPandas(count, "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))
    top = counts.select("h", F.least("n", F.lit(2**31 - 1)).cast("int").alias("n")).orderBy(F.col("n").desc(), "h").limit(FREQUENT).toArrow()
    hashes, often = top["h"].to_numpy().view(np.uint64), top["n"].to_numpy()
    order = np.argsort(hashes, kind="stable")
    return hashes[order], often[order]


def bitmap(shingles: np.ndarray, width: int) -> np.ndarray:
    """Bit ``i`` is the parity of the number of shingles whose last bits are ``i``; as longs."""
    parity = np.bincount((shingles & U(width - 1)).astype(np.int64), minlength=width) & 1
    return np.packbits(parity.astype(np.uint8)).view(np.int64)


def profiles(docs: DataFrame, rule: Similarity, frequent: tuple[np.ndarray, np.ndarray], keep: tuple[str, ...] = ("id",)) -> DataFrame:
    """``id, n, d1, d2, bits, brief, tiles`` per document: set size, a 128-bit digest of the set, bitmaps, tile keys."""
    shared = docs.sparkSession.sparkContext.broadcast(frequent)

    def setup() -> Callable[[pd.DataFrame], pd.DataFrame]:
        hashes, counts = shared.value
        ends = rule.upper_ends(100_000)

        def one(own: np.ndarray) -> tuple:
            size = len(own)
            if not size:
                return 0, 0, 0, [], [], []
            bits, brief = (bitmap(own, width) for width in (max(64, 1 << (size - 1).bit_length()), 64 * BRIEF_LONGS))
            first = own[: rule.prefix(size)]
            if len(hashes):
                at = np.minimum(np.searchsorted(hashes, own), len(hashes) - 1)
                often = np.where(hashes[at] == own, counts[at], 0)
                if often.any():
                    first = own[np.lexsort((own, often))[: rule.prefix(size)]]
            uppers = ends if size <= ends[-1] else rule.upper_ends(size)
            band = int(np.searchsorted(uppers, size))
            bands = [band] if rule.den * size // rule.num <= uppers[band] else [band, band + 1]
            keys = np.concatenate([mix(first ^ mix(np.full(1, k + 1, dtype=np.uint64))) for k in bands])
            digest = [int(mix(h).sum(dtype=np.uint64).view(np.int64)) for h in (own, own ^ U(0x5851F42D4C957F2D))]
            return size, *digest, bits, brief, keys.view(np.int64)

        def profile(part: pd.DataFrame) -> pd.DataFrame:
            return pd.DataFrame([one(own) for own in shingle_sets(part["text"].tolist(), rule.n)], columns=["n", "d1", "d2", "bits", "brief", "tiles"])

        return profile

    found = per_row({"text": F.col("text")}, setup, "n long, d1 long, d2 long, bits array<long>, brief array<long>, tiles array<long>")
    return docs.select(*keep, found.alias("found")).select(*keep, "found.*")


def differing_bits(a: Column, b: Column) -> Column:
    """Number of bits in which two bitmaps differ; the wider one is folded to the width of the other.

    Bit ``i`` stands for the shingles with ``i`` as their last bits, so the halves of a bitmap, added
    bit by bit, are the bitmap of half the width. Sizes that can be similar are at most one step apart.
    """

    def folded(wide: Column, other: Column) -> Column:
        half = (F.size(wide) / 2).cast("int")
        return F.when(
            F.size(wide) > F.size(other), F.zip_with(F.slice(wide, F.lit(1), half), F.slice(wide, half + 1, half), lambda x, y: x.bitwiseXOR(y))
        ).otherwise(wide)

    each = F.zip_with(folded(a, b), folded(b, a), lambda x, y: F.bit_count(x.bitwiseXOR(y)))
    return F.aggregate(each, F.lit(0), lambda total, n: total + F.coalesce(n, F.lit(0)))


def differing_brief_bits(a: Column, b: Column) -> Column:
    """Number of bits in which two brief bitmaps differ."""
    total = F.lit(0)
    for i in range(BRIEF_LONGS):
        total = total + F.bit_count(a[i].bitwiseXOR(b[i]))
    return total


def verified(pairs: DataFrame, members: DataFrame, docs: DataFrame, rule: Similarity) -> DataFrame:
    """The pairs ``(a, b)`` of documents whose sets are similar: first by bitmap, then exactly."""
    sizes = members.select("id", "n", "bits")
    bounded = (
        pairs.join(sizes.withColumnsRenamed({"id": "a", "n": "n_a", "bits": "bits_a"}), "a")
        .join(sizes.withColumnsRenamed({"id": "b", "n": "n_b", "bits": "bits_b"}), "b")
        .filter(rule.possible(F.col("n_a"), F.col("n_b"), differing_bits(F.col("bits_a"), F.col("bits_b"))))
        .select("a", "b").distinct()
    )
    sides = bounded.select("a", "b", F.explode(F.array(F.struct(F.col("a").alias("id"), F.lit(0).alias("side")), F.struct(F.col("b").alias("id"), F.lit(1).alias("side")))).alias("s"))
    sides = sides.select("a", "b", "s.id", "s.side")
    sides = stored(sides, "sides")
    # Two texts a pair, or as many as there are rows with the two ids.
    texts = sides.join(may_be_among(docs, "id", sides.select("id")), "id").groupBy("a", "b").agg(F.collect_list(F.struct("side", "text")).alias("texts"))

    def check(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            linked = []
            for texts in frame["texts"]:
                sets = shingle_sets([t["text"] or "" for t in texts], rule.n)
                left = [s for s, t in zip(sets, texts, strict=True) if t["side"] == 0 and len(s)]
                right = [s for s, t in zip(sets, texts, strict=True) if t["side"] == 1 and len(s)]
                linked.append(any(rule.similar(len(np.intersect1d(x, y, assume_unique=True)), len(x), len(y)) for x in left for y in right))
            yield frame.loc[linked, ["a", "b"]]

    kind = pairs.schema["a"].dataType.simpleString()
    return texts.mapInPandas(check, f"a {kind}, b {kind}")


def salts(round_: int) -> list[int]:
    """Numbers, others in every round, that reorder ids by exclusive or."""
    return mix(np.arange(round_ * MET + 1, (round_ + 1) * MET + 1, dtype=np.uint64)).view(np.int64).tolist()


def crowded_pairs(crowd: DataFrame, sized: DataFrame, rule: Similarity, round_: int) -> DataFrame:
    """Pairs ``(a, b)`` of sets that may be similar, each of a crowded tile with the ``MET`` that come first there in orders of this round.

    Of the sets of one other component that a set meets, only the one whose brief bitmap differs least is taken.
    """
    rows = crowd.join(sized.select("rep", "component"), "rep")
    firsts = [F.min(F.col("rep").bitwiseXOR(F.lit(salt))).bitwiseXOR(F.lit(salt)) for salt in salts(round_)]
    met = rows.groupBy("tile").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.array_distinct(F.array(*firsts)).alias("met")).filter("lo != hi")
    pairs = rows.select("tile", "rep").join(met.select("tile", "met"), "tile").select("rep", F.explode("met").alias("rep_b")).filter("rep != rep_b").distinct()
    other = sized.withColumnsRenamed({"rep": "rep_b", "component": "component_b", "n": "n_b", "brief": "brief_b"})
    differing = differing_brief_bits(F.col("brief"), F.col("brief_b"))
    near = pairs.join(sized, "rep").join(other, "rep_b").filter(F.col("component") != F.col("component_b")).select(
        "rep", "rep_b", "component_b", "n", "n_b", differing.alias("differing")
    ).filter(rule.possible(F.col("n"), F.col("n_b"), F.col("differing")))
    nearest = near.groupBy("rep", "component_b").agg(F.min(F.struct("differing", "rep_b")).alias("nearest"))
    return nearest.select(F.least("rep", "nearest.rep_b").alias("a"), F.greatest("rep", "nearest.rep_b").alias("b")).distinct()


def join(docs: DataFrame, rule: Similarity, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, n_shingles, component_id`` of every row: set size and the smallest id reachable by links.

    For components alone: links inside a component that is already found are not looked for;
    ``links`` finds all of them.

    Null and empty texts have no shingles and are linked with nothing; their component is their
    own id. Rows that share an id are one document: a link of any of their texts is a link of
    the id, and each row is returned. Rows with a null id are returned with a null component.
    Other columns don't matter. Sets are told apart by size and 128 bits, shingles by 64.
    """
    spark: SparkSession = docs.sparkSession
    whole = docs.select(plain(key).cast("long").alias("id"), plain(text).alias("text"))
    rows = stored(profiles(whole, rule, frequent_shingles(whole, rule)), "profiles")
    sets = rows.filter("n > 0 AND id IS NOT NULL")
    # One set, one representative.
    classes = stored(sets.groupBy("n", "d1", "d2").agg(F.min("id").alias("rep")), "classes")
    members = stored(
        sets.select("id", "n", "d1", "d2", "bits", "brief").join(classes, ["n", "d1", "d2"]).select("id", "n", "bits", "brief", "rep"), "members"
    )
    tiles = sets.select("id", F.explode("tiles").alias("tile"))
    shared = tiles.groupBy("tile").agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("many")).filter("many > 1")
    tiled = stored(tiles.join(shared, "tile"), "tiles")
    reps = members.select("id", "rep").distinct()

    def between_reps(pairs: DataFrame) -> DataFrame:
        mapped = pairs.join(reps.withColumnsRenamed({"id": "a", "rep": "rep_a"}), "a").join(
            reps.withColumnsRenamed({"id": "b", "rep": "rep_b"}), "b"
        )
        return mapped.filter("rep_a != rep_b").select(F.least("rep_a", "rep_b").alias("a"), F.greatest("rep_a", "rep_b").alias("b")).distinct()

    own = whole.filter("id IS NOT NULL AND text IS NOT NULL")
    # An id with several sets belongs to several classes: those are one document.
    firsts = reps.groupBy("id").agg(F.min("rep").alias("a"))
    same = reps.join(firsts, "id").filter("rep != a").select("a", F.col("rep").alias("b"))
    # One comparison a document: with the smallest id of all its tiles.
    nearest = tiled.groupBy("id").agg(F.min("least").alias("a")).filter("a != id").select("a", F.col("id").alias("b"))
    stars = stored(between_reps(nearest), "stars")
    links = stored(verified(stars, members, own, rule).unionByName(same), "links")
    found = components(links)
    # Groups of near copies grow together before any tile is joined with itself.
    crowd = tiled.filter(F.col("many") > CROWD).select("tile", "id").join(reps, "id").select("tile", "rep").distinct()
    crowd = stored(crowd, "crowd")
    briefs = members.filter("id = rep").select("rep", "n", "brief").distinct()
    tested = stars
    for round_ in range(ROUNDS if not crowd.isEmpty() else 0):
        sized = briefs.join(found.withColumnsRenamed({"id": "rep"}), "rep", "left").withColumn("component", F.coalesce("component", "rep"))
        pairs = stored(crowded_pairs(crowd, sized, rule, round_).join(tested, ["a", "b"], "left_anti"), "met")
        linked = stored(verified(pairs, members, own, rule), "links")
        if linked.isEmpty():
            break
        tested, links = tested.unionByName(pairs), stored(links.unionByName(linked), "links")
        found = components(links)
    # What is left: tiles with documents of different components.
    placed = stored(
        members.select("id", "rep", "n", "brief").join(found.withColumnsRenamed({"id": "rep"}), "rep", "left")
        .select("id", "rep", "n", "brief", F.coalesce("component", "rep").alias("component")), "placed",
    )
    spread = stored(tiled.select("tile", "id").join(placed.select("id", "rep", "component"), "id").select("tile", "rep", "component").distinct(), "spread")
    mixed = spread.groupBy("tile").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).filter("lo != hi").select("tile")
    sized = placed.filter("id = rep").select("rep", "n", "brief")
    # A pair that also meets in one of the last tiles of both, in one order for all, was found there.
    by_tile = Window.partitionBy("rep").orderBy("tile")
    earlier = F.array_compact(F.array(*[F.lag("tile", k).over(by_tile) for k in range(1, EARLIER + 1)]))
    left = stored(
        spread.join(mixed, "tile").withColumn("earlier", earlier).join(sized, "rep").select("tile", "rep", "component", "n", "brief", "earlier"), "left"
    )
    right = left.withColumnsRenamed(
        {"tile": "tile_b", "rep": "rep_b", "component": "component_b", "n": "n_b", "brief": "brief_b", "earlier": "earlier_b"}
    )
    across = left.join(
        right,
        (F.col("tile") == F.col("tile_b")) & (F.col("component") < F.col("component_b"))
        & rule.possible(F.col("n"), F.col("n_b"), differing_brief_bits(F.col("brief"), F.col("brief_b")))
        & ~F.arrays_overlap("earlier", "earlier_b"),
    ).select(F.least("rep", "rep_b").alias("a"), F.greatest("rep", "rep_b").alias("b")).distinct()
    untested = across.join(tested, ["a", "b"], "left_anti")
    more = stored(verified(untested, members, own, rule), "links")
    final = found if more.isEmpty() else components(links.unionByName(more))
    labels = members.select("id", "rep").groupBy("id").agg(F.min("rep").alias("rep")).join(
        final.withColumnsRenamed({"id": "rep"}), "rep", "left"
    ).select("id", F.coalesce("component", "rep").alias("component"))
    return rows.select("id", "n").join(labels.withColumnRenamed("id", "labelled"), F.col("id") == F.col("labelled"), "left").select(
        F.col("id").alias(key), F.col("n").alias("n_shingles"), F.coalesce("component", "id").alias("component_id")
    )


def links(docs: DataFrame, rule: Similarity, key: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """All links, as pairs of sets ``set_a, set_b``, and the rows' sets: ``key, set, n_shingles, component_id, n_links``.

    Two documents are linked if they have one set or two sets of a pair (``set_a < set_b``, different
    ones). ``n_links`` is the number of other ids that an id is linked with, ``component_id`` the
    smallest id reachable. Rows are as in ``join``; without shingles or id their set and
    ``n_links`` are null and 0. The pairs are as many as there are similar sets, in a group of
    near copies up to the square of its size; equal texts add none.
    """
    whole = docs.select(plain(key).cast("long").alias("id"), plain(text).alias("text"))
    rows = stored(
        profiles(whole, rule, frequent_shingles(whole, rule), ("id", "text")).withColumn("set", F.when((F.col("n") > 0) & F.col("id").isNotNull(), F.format_string("%d-%016x-%016x", "n", "d1", "d2"))), "profiles",
    )
    own = rows.filter("set IS NOT NULL")
    # One text a set: its smallest.
    sets = own.groupBy("set").agg(F.min("id").alias("rep"), F.min("n").alias("n"), F.min("bits").alias("bits"), F.min("brief").alias("brief"), F.min("tiles").alias("tiles"))
    sets = stored(sets, "sets")
    sided = sets.select(F.explode("tiles").alias("tile"), "set", "n", "brief")
    other = sided.withColumnsRenamed({"tile": "tile_b", "set": "set_b", "n": "n_b", "brief": "brief_b"})
    possible = sided.join(
        other,
        (F.col("tile") == F.col("tile_b")) & (F.col("set") < F.col("set_b"))
        & rule.possible(F.col("n"), F.col("n_b"), differing_brief_bits(F.col("brief"), F.col("brief_b"))),
    ).select(F.col("set").alias("a"), F.col("set_b").alias("b")).distinct()
    possible = stored(possible, "possible")
    ends = possible.select(F.col("a").alias("set")).unionByName(possible.select(F.col("b").alias("set")))
    texts = may_be_among(own.select("set", "text"), "set", ends).groupBy("set").agg(F.min("text").alias("text"))
    pairs = stored(verified(possible, sets.withColumnRenamed("set", "id"), texts.withColumnRenamed("set", "id"), rule), "pairs")

    members = stored(own.select("id", "set").distinct(), "members")
    near = stored(
        pairs.select(F.col("a").alias("set"), F.col("b").alias("other")).unionByName(pairs.select(F.col("b").alias("set"), F.col("a").alias("other")))
        .unionByName(sets.select("set", F.col("set").alias("other"))), "near",
    )
    # Ids of one set are counted by set; those of several are told apart, as they may be met in several ways.
    several = members.groupBy("id").agg(F.count(F.lit(1)).alias("many")).filter("many > 1").select("id")
    multiple = stored(members.join(several, "id"), "multiple")
    single = members.join(several, "id", "left_anti")
    alone = single.groupBy("set").agg(F.count(F.lit(1)).alias("ids")).withColumnRenamed("set", "other")
    met = multiple.select(F.col("id").alias("met"), F.col("set").alias("other"))
    by_set = near.join(alone, "other").groupBy("set").agg(F.sum("ids").alias("ids")).join(
        near.join(met, "other").select("set", "met").distinct().groupBy("set").agg(F.count(F.lit(1)).alias("met")), "set", "full"
    ).select("set", (F.coalesce("ids", F.lit(0)) + F.coalesce("met", F.lit(0))).alias("n_links"))
    reach = multiple.join(near, "set").select("id", "other").distinct()
    by_id = reach.join(alone, "other").select("id", "ids").unionByName(
        reach.join(met, "other").filter("id != met").select("id", "met").distinct().select("id", F.lit(1).cast("long").alias("ids"))
    ).groupBy("id").agg(F.sum("ids").alias("n_links"))
    counts = single.join(by_set, "set").select("id", (F.col("n_links") - 1).alias("n_links")).unionByName(by_id)

    reps = sets.select("set", "rep")
    edges = pairs.join(reps.withColumnsRenamed({"set": "a", "rep": "rep_a"}), "a").join(reps.withColumnsRenamed({"set": "b", "rep": "rep_b"}), "b").select(
        F.col("rep_a").alias("a"), F.col("rep_b").alias("b")
    )
    same = members.join(reps, "set").filter("id != rep").select(F.col("rep").alias("a"), F.col("id").alias("b"))
    found = components(edges.unionByName(same)).withColumnRenamed("id", "labelled")
    counted = counts.withColumnRenamed("id", "counted")
    out = rows.select("id", "set", "n").join(found, F.col("id") == F.col("labelled"), "left").join(counted, F.col("id") == F.col("counted"), "left")
    return pairs.select(F.col("a").alias("set_a"), F.col("b").alias("set_b")), out.select(
        F.col("id").alias(key), "set", F.col("n").alias("n_shingles"), F.coalesce("component", "id").alias("component_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links")
    )



def one_of_each(docs: DataFrame, rule: Similarity, key: str = "doc_id", text: str = "text") -> DataFrame:
    """All columns of the row that stays of every component of similar texts: the one of smallest id.

    Rows are judged by id and text: those with one id and different texts are different documents,
    and those of one id in one component are ordered by a hash. Of rows with one id and one text one
    stays, the first by its JSON. Rows with a null id, a null text or an empty one are linked
    with nothing and stay. Id and text are told apart by 64 bits.
    """
    rows = docs.select(
        plain(key).cast("long").alias("id"), F.when(plain(key).isNotNull(), F.xxhash64(plain(key).cast("long"), plain(text))).alias("node"),
        plain(text).alias("text"), F.struct(*[plain(c) for c in docs.columns]).alias("row"),
    )
    found = stored(join(rows.select("node", "text"), rule, "node", "text"), "components").filter("n_shingles > 0 AND node IS NOT NULL")
    nodes = found.groupBy("node").agg(F.first("component_id").alias("component"), F.count(F.lit(1)).alias("times"))
    several = found.groupBy("component_id").agg(F.count(F.lit(1)).alias("many")).filter("many > 1").select("component_id")
    affected = stored(nodes.join(several, F.col("component") == F.col("component_id")).select("node", "component", "times"), "affected")
    # Only rows that may be affected are shuffled.
    others = may_be_among(rows, "node", affected.select("node"), "left_anti")
    among = may_be_among(rows, "node", affected.select("node"))
    owners = among.select("id", "node").distinct().join(affected, "node")
    first = owners.groupBy("component").agg(F.min(F.struct("id", "node")).alias("first")).select("first.node")
    stay = stored(first.join(affected, "node").select("node", "times"), "first")
    gone = affected.join(stay.select("node"), "node", "left_anti").select(F.col("node").alias("gone"))
    judged = among.join(gone, F.col("node") == F.col("gone"), "left_anti")
    repeated = stay.filter("times > 1").select(F.col("node").alias("repeated"))
    once = judged.join(repeated, F.col("node") == F.col("repeated"), "left_anti")
    one = judged.join(repeated, F.col("node") == F.col("repeated")).groupBy("node").agg(F.min_by("row", F.to_json("row")).alias("row"))
    return others.select("row.*").unionByName(once.select("row.*")).unionByName(one.select("row.*"))
