"""N-gram Jaccard join with prefix filters under several global token orders.

A document's set holds its distinct word shingles. Under any order of all shingles, two
sets that are similar enough share a shingle among the first few of each (their
prefixes). Candidates share a prefix shingle under a first order, which puts shingles of
very many documents last; under a second and third order the prefixes must agree too, up
to what the threshold lets two sets differ. Only pairs that pass all filters have their
whole sets compared, so the answer is exact.

Equal sets are one class. Documents that share a prefix shingle are first compared with
a few members of that group only, its centres; the components found so far then leave few
pairs, those between components. Two such sets can only link where they differ from the
centre in the same shingles, so in large groups their remaining pairs are joined on the
first of these differences. A large group of near copies thus costs a few comparisons a document, not
one a pair, and no link between components is missed.

Only components come out, exactly. Links are no output: pairs inside a component are
mostly not compared, so neither all pairs nor links per document can be read off.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..storage import discard, materialize
from .common import bitmap, content_hash, in_bitmap, let_go, row_key, rows_in_bitmap, spare
from .components import components

#: Shingles of at least so many documents count as frequent.
FREQUENT = 20
#: Members that all of a group are compared with first: four at most.
CENTRES = 4
COUNTED_AT_ONCE = 4_000_000
#: Classes a task remembers, so that it gives each of them once.
REMEMBERED = 200_000
#: Members of groups up to this size are paired directly once the centres are compared:
#: so many pairs a member at most. Larger groups are joined by what sets members off.
SMALL_GROUP = 200

_MULTIPLIERS = np.array([2 * int.from_bytes(xxhash.xxh64_digest(f"word {i}"), "big") + 1 & (1 << 64) - 1 for i in range(64)], np.uint64)


def _mixed(x: np.ndarray, salt: int) -> np.ndarray:
    """A bijection of 64-bit numbers that leaves no visible order."""
    x = x ^ (x >> np.uint64(32))  # a copy; the rest is done in place
    x *= _MULTIPLIERS[salt]
    x ^= x >> np.uint64(29)
    x *= _MULTIPLIERS[salt + 1]
    x ^= x >> np.uint64(32)
    return x


class _Words(dict):
    """Hashes of words seen by this worker, as bytes; cleared when it grows large."""

    def __missing__(self, word: bytes) -> bytes:
        if len(self) > 200_000:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word).to_bytes(8, "little")
        return value


_words = _Words()


def shingles(text: str | None, words: int) -> np.ndarray:
    """The sorted 64-bit hashes of a text's distinct shingles. ASCII letters are lowered
    and words end at ASCII white space. With fewer words the whole sequence is one
    shingle; a text without words has none."""
    tokens = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not tokens:
        return np.zeros(0, np.uint64)
    hashes = np.frombuffer(b"".join(map(_words.__getitem__, tokens)), "<u8")
    width = min(words, len(tokens))
    total = np.zeros(len(tokens) - width + 1, np.uint64)
    for i in range(width):
        total = _mixed(total + hashes[i : i + len(total)] * _MULTIPLIERS[8 + i % 40], 2)
    if width < words:
        total = _mixed(total + np.uint64(width), 4)  # never equal to a full shingle
    total.sort()
    return total[np.append(True, total[1:] != total[:-1])]  # np.unique takes ten times as long


def prefix_length(size: int, percent: int) -> int:
    """How many of a set's first shingles must hold one of any similar enough set."""
    return size + (-percent * size) // 100 + 1


def _narrow(order: np.ndarray, keep: int) -> np.ndarray:
    """The smallest values of an order, cut to 32 bits for comparison."""
    return np.sort(np.partition(order, keep - 1)[:keep] >> np.uint64(32)).astype(np.uint32) if keep < len(order) else np.sort(order >> np.uint64(32)).astype(np.uint32)


def _may_link(a: np.ndarray, b: np.ndarray, allowed: int) -> bool:
    """Whether two sets' prefixes under one order leave room for at most ``allowed``
    differing shingles: below the lower of the prefixes' ends, all of both sets is known.
    Equal 32-bit values may stand for different shingles, which only lets pairs pass."""
    end = min(a[-1], b[-1])
    left, right = np.searchsorted(a, end, "left"), np.searchsorted(b, end, "left")
    at = np.searchsorted(b[:right], a[:left])
    common = int((b[:right][np.minimum(at, right - 1)] == a[:left]).sum()) if left and right else 0
    # Repeated 32-bit values can match several times, never fewer.
    return left + right - 2 * common <= allowed


def _shingled(docs: DataFrame, words: int) -> DataFrame:
    """A row per document (doc_id, key, n, class_hash), and rows with n = -1 that hold
    shingles found in several documents of a task (or of each so many of its shingles)."""

    def several(held: list[np.ndarray], like: pd.Series) -> Iterator[pd.DataFrame]:
        tokens, counts = np.unique(np.concatenate(held), return_counts=True) if held else (np.zeros(0, np.uint64), np.zeros(0, int))
        tokens, counts = tokens[counts > 1].view(np.int64), counts[counts > 1]
        held.clear()
        if len(tokens):
            none = pd.Series([None], dtype="object" if like.dtype == object else "Int64")
            yield pd.DataFrame({"doc_id": none, "key": [None], "n": [-1], "class_hash": [b""], "tokens": [tokens], "counts": [counts]})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[np.ndarray] = []
        seen: set[bytes] = set()
        size, like = 0, pd.Series([0])
        for batch in batches:
            like = batch["doc_id"]
            sets = [shingles(x, words) for x in batch["text"]]
            hashes = [xxhash.xxh3_128_digest(x.tobytes()) for x in sets]
            yield pd.DataFrame({"doc_id": like, "key": batch["key"], "n": [len(x) for x in sets], "class_hash": hashes, "tokens": None, "counts": None})
            for name, own in zip(hashes, sets):
                if name not in seen:
                    seen.add(name)
                    held.append(own)
                    size += len(own)
            if size > COUNTED_AT_ONCE:
                yield from several(held, like)
                seen.clear()
                size = 0
        yield from several(held, like)

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInPandas(run, f"doc_id {kind}, key binary, n bigint, class_hash binary, tokens array<bigint>, counts array<bigint>")


def _frequent(shingled: DataFrame) -> np.ndarray:
    """A bitmap of the frequent shingles. Counts come from all documents, less the shingles
    a task holds only once; any set gives right results, as it only changes the order."""
    counted = shingled.filter("n < 0").select(F.explode(F.arrays_zip("tokens", "counts")).alias("x"))
    sums = counted.groupBy(F.col("x.tokens").alias("token")).agg(F.sum("x.counts").alias("count"))
    often = materialize(sums.filter(F.col("count") >= FREQUENT).select("token"), "frequent")
    known = bitmap(often, "token")
    discard(often)
    return known


def _classes(docs: DataFrame, words: int, percent: int, frequent: np.ndarray) -> DataFrame:
    """A row per class and task, written: c (a number), class_hash, text_key (of one
    member's text), n, prefix under the first order, and narrow prefixes under the second and third."""
    shared = docs.sparkSession.sparkContext.broadcast(frequent)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = shared.value
        seen: set[bytes] = set()
        for batch in batches:
            rows = []
            if len(seen) > REMEMBERED:
                seen.clear()
            for text_key, text in zip(batch["text_key"], batch["text"]):
                tokens = shingles(text, words)
                name = xxhash.xxh3_128_digest(tokens.tobytes())
                if not len(tokens) or name in seen:
                    continue
                seen.add(name)
                keep = prefix_length(len(tokens), percent)
                late = in_bitmap(tokens.view(np.int64), known)
                first = np.concatenate([tokens[~late], tokens[late]])
                orders = [_narrow(_mixed(tokens, salt), keep).tobytes() for salt in (50, 54)]
                rows.append((name, text_key, len(tokens), first[:keep].view(np.int64), *orders))
            yield pd.DataFrame(rows, columns=["class_hash", "text_key", "n", "prefix", "second", "third"])

    schema = "class_hash binary, text_key binary, n bigint, prefix array<bigint>, second binary, third binary"
    found = docs.select("text", content_hash(F.col("text")).alias("text_key")).mapInPandas(run, schema)
    return materialize(found.withColumn("c", F.monotonically_increasing_id()), "classes")


def _firsts(classes: DataFrame) -> DataFrame:
    """(c, first): the first number of each row's class, written."""
    first = F.min("c").alias("first")
    firsts = classes.groupBy("class_hash").agg(first)
    return materialize(classes.select("c", "class_hash").join(firsts, "class_hash").select("c", "first"), "first-numbers")


def _shared(classes: DataFrame, firsts: DataFrame) -> DataFrame:
    """(token, c, n, breadth): prefix shingles that several classes hold, written; c is the
    first number of a class, breadth how many such shingles its prefix has.

    Most shingles have one holder. They are told apart by two numbers a shingle, and leave
    before anything else is moved.
    """
    holders = classes.select(F.explode("prefix").alias("token"), "c").groupBy("token")
    common = holders.agg(F.min("c").alias("low"), F.max("c").alias("high")).filter("low <> high").select("token")
    common = materialize(common, "common-shingles")
    shared = classes.sparkSession.sparkContext.broadcast(bitmap(common, "token"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch["prefix"].value_lengths().to_numpy().astype(np.int64)
            tokens = batch["prefix"].flatten().to_numpy()
            row = np.repeat(np.arange(len(sizes)), sizes)
            kept = in_bitmap(tokens, shared.value)
            tokens, row = tokens[kept], row[kept]
            breadth = np.bincount(row, minlength=len(sizes))
            columns = [tokens, batch["c"].to_numpy()[row], batch["n"].to_numpy()[row], breadth[row]]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], ["token", "c", "n", "breadth"])

    entries = classes.select("c", "n", "prefix").mapInArrow(run, "token bigint, c bigint, n bigint, breadth bigint")
    found = entries.join(common, "token").join(firsts, "c").select("token", F.col("first").alias("c"), "n", "breadth")
    found = materialize(found, "shared-shingles")
    discard(common)
    return found


def _filtered(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Pairs that may link by size, and by the second and the third order's prefixes. The
    narrow test comes first, so few pairs get the prefixes attached, and only the prefixes
    of classes in such pairs are moved."""

    def side(table: DataFrame, s: str, *columns: str) -> DataFrame:
        return table.select(F.col("c").alias(s), *[F.col(x).alias(f"{x}_{s}") for x in columns])

    def agree(order: str):
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                keep = []
                for n, m, a, b in zip(batch["n_a"], batch["n_b"], batch[f"{order}_a"], batch[f"{order}_b"]):
                    # |A ^ B| <= (1 - t) / (1 + t) * (|A| + |B|)
                    allowed = (100 - percent) * (n + m) // (100 + percent)
                    keep.append(_may_link(np.frombuffer(a, np.uint32), np.frombuffer(b, np.uint32), allowed))
                yield batch.loc[np.array(keep, bool), ["a", "b", "n_a", "n_b"]]

        return run

    sized = pairs.join(side(classes, "a", "n"), "a").join(side(classes, "b", "n"), "b")
    left = materialize(sized.filter(f"100 * least(n_a, n_b) >= {percent} * greatest(n_a, n_b)"), "sized-pairs")
    few = materialize(_some(classes.select("c", "second", "third"), left), "pair-prefixes")
    for order in ("second", "third"):
        both = left.join(side(few, "a", order), "a").join(side(few, "b", order), "b")
        passed = materialize(both.mapInPandas(agree(order), "a bigint, b bigint, n_a bigint, n_b bigint"), f"pairs-{order}")
        discard(left)
        left = passed
    discard(few)
    return left.select("a", "b")


def _ids(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.explode(F.array("a", "b")).alias("c")).distinct()


def _some(table: DataFrame, pairs: DataFrame) -> DataFrame:
    """Rows of a table of classes that (nearly) all occur in the pairs, without moving any."""
    hashed = materialize(_ids(pairs).select(F.xxhash64("c").alias("hash")), "pair-ids")
    known = bitmap(hashed, "hash")
    discard(hashed)
    return rows_in_bitmap(table, F.xxhash64("c"), known)


def _texts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(c, text) of the wanted classes (c, text_key), written. A text is smaller than its set
    of shingles, so texts travel and sets are made where they meet. Texts of other classes
    are passed over where they lie; copies are dropped where texts meet their names."""
    hashed = materialize(wanted.select("c", "text_key", F.xxhash64("text_key").alias("hash")), "text-keys")
    keyed = docs.select("text").withColumn("text_key", content_hash(F.col("text")))
    found = rows_in_bitmap(keyed, F.xxhash64("text_key"), bitmap(hashed, "hash"))
    found = found.dropDuplicates(["text_key"]).join(hashed.select("c", "text_key"), "text_key")
    found = materialize(found.select("c", "text"), "texts")
    discard(hashed)
    return found


def _side(texts: DataFrame, s: str) -> DataFrame:
    return texts.select(F.col("c").alias(s), F.col("text").alias(f"text_{s}"))


def _verified(pairs: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """Pairs whose whole sets are similar enough."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            keep = []
            for x, y in zip(batch["text_a"], batch["text_b"]):
                a, b = shingles(x, words), shingles(y, words)
                both = int((b[np.minimum(np.searchsorted(b, a), len(b) - 1)] == a).sum())
                keep.append(100 * both >= percent * (len(a) + len(b) - both))
            yield batch.loc[np.array(keep, bool), ["a", "b"]]

    both = pairs.join(_side(texts, "a"), "a").join(_side(texts, "b"), "b")
    return materialize(both.mapInPandas(run, "a bigint, b bigint"), "links")


def _ordered(a: str, b: str) -> list:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def _links(docs: DataFrame, classes: DataFrame, firsts: DataFrame, words: int, percent: int, frequent: np.ndarray) -> DataFrame:
    """Links between classes, written: enough to join all that belong together. Other
    tables on the way are removed."""
    spark = docs.sparkSession
    shared = _shared(classes, firsts)
    let_go(spark)
    # First every member of a group with those that share most of their prefix, which are
    # the least changed of near copies, and with two more.
    central = [F.max_by("c", F.struct("breadth", "c")), F.max_by("c", F.struct("breadth", -F.col("c"))), F.min("c"), F.max("c")]
    central = [x.alias(f"m{i}") for i, x in enumerate(central[:CENTRES])]
    ends = materialize(shared.groupBy("token").agg(*central), "centres")
    paired = shared.select("token", "c").join(ends, "token")
    tested = paired.select("c", F.explode(F.array_distinct(F.array(*[f"m{i}" for i in range(CENTRES)]))).alias("end")).filter("c <> end").select(*_ordered("c", "end")).distinct()
    tested = materialize(tested, "first-pairs")
    passed = _filtered(tested, classes, percent)
    let_go(spark)
    named = classes.select("c", "text_key")
    texts = _texts(docs, named.join(_ids(passed), "c", "left_semi"))
    links = _verified(passed, texts, words, percent)
    discard(texts)
    let_go(spark)
    # Then members of different components, by what sets each off from its centre.
    roots = components(links)
    rooted = shared.join(roots.select(F.col("node").alias("c"), "root"), "c", "left")
    rooted = rooted.select("token", "c", "n", F.coalesce("root", "c").alias("root"))
    mixed = rooted.groupBy("token").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.count("*").alias("size"))
    mixed = mixed.filter("low <> high AND size > 2").select("token", "size")
    open_ = materialize(rooted.join(mixed, "token").join(ends.select("token", F.col("m0").alias("centre")), "token"), "open-groups")
    small = open_.filter(F.col("size") <= SMALL_GROUP)
    sides = [small.select("token", *[F.col(x).alias(f"{x}{i}") for x in ("c", "n", "root")]) for i in (1, 2)]
    near = f"c1 < c2 AND root1 <> root2 AND 100 * least(n1, n2) >= {percent} * greatest(n1, n2)"
    direct = sides[0].join(sides[1], "token").filter(near).select(*_ordered("c1", "c2"))
    large = open_.filter((F.col("size") > SMALL_GROUP) & (F.col("c") != F.col("centre")))
    clans = materialize(large.select("centre", "c", "root").distinct(), "clans")
    members = clans.select(F.explode(F.array("centre", "c")).alias("c")).distinct()
    texts = _texts(docs, named.join(members, "c", "left_semi"))
    edits = materialize(_edits(clans, texts, words, percent, frequent), "edits")
    discard(texts)
    let_go(spark)
    left = edits.filter("short").select("key", *[F.col(x).alias(f"{x}1") for x in ("c", "root", "n", "differs", "place")])
    right = edits.drop("short").toDF("key", *[f"{x}2" for x in ("c", "root", "n", "differs", "place")])
    room = f"(differs1 + differs2 - {100 - percent} * (n1 + n2) DIV {100 + percent})"
    near = f"root1 <> root2 AND (differs1, c1) < (differs2, c2) AND 100 * least(n1, n2) >= {percent} * greatest(n1, n2)"
    near += f" AND 2 * (differs1 - place1) >= {room} AND 2 * (differs2 - place2) >= {room}"
    apart = left.join(right, "key").filter(near).select(*_ordered("c1", "c2"))
    cross = direct.unionByName(apart).distinct().join(tested, ["a", "b"], "left_anti")
    cross = _filtered(cross, classes, percent)
    let_go(spark)
    texts = _texts(docs, named.join(_ids(cross), "c", "left_semi"))
    found = materialize(links.unionByName(_verified(cross, texts, words, percent)), "all-links")
    discard(shared, ends, tested, open_, clans, edits, texts)
    return found


def _edits(clans: DataFrame, texts: DataFrame, words: int, percent: int, frequent: np.ndarray) -> DataFrame:
    """The first shingles in which each class differs from its centre, under an order all
    of a centre's classes share: those the centre lacks first, frequent ones after others.

    Let D be how many shingles two sets that link may differ in. Where two classes differ
    from the centre in no more than D together, both link with it, so they are in one
    component. All others that link share differences. The one with fewer has one of them
    among its first D / 2 + 1 (``short`` rows), the other among its first D + 1.
    """
    shared = clans.sparkSession.sparkContext.broadcast(frequent)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = shared.value
        for batch in batches:
            for centre, c, root, x, y in zip(batch["centre"], batch["c"], batch["root"], batch["text_c"], batch["text_centre"]):
                own, base = shingles(x, words), shingles(y, words)
                added, missing = np.setdiff1d(own, base, True), np.setdiff1d(base, own, True)
                added, missing = (t[np.argsort(_mixed(t, 58))] for t in (added, missing))
                late = in_bitmap(added.view(np.int64), known)
                order = np.concatenate([added[~late], added[late], missing])
                most = (100 - percent) * len(own) // percent  # D, for a partner as large as any
                first = order[: most + 1]
                key = _mixed(first + np.array([centre], np.uint64) * _MULTIPLIERS[48], 2).view(np.int64)
                place = np.arange(len(first))
                yield pd.DataFrame({"key": key, "c": c, "root": root, "n": len(own), "differs": len(order), "place": place, "short": place <= most // 2})

    both = clans.join(_side(texts, "c"), "c").join(_side(texts, "centre"), "centre")
    return both.mapInPandas(run, "key bigint, c bigint, root bigint, n bigint, differs bigint, place bigint, short boolean")


def near_groups(docs: DataFrame, words: int = 4, percent: int = 85, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (the smallest doc_id that
    links reach).

    Two documents link when 100 * shared >= percent * all of their shingles. Texts that
    are null or without words have no shingles and link with nothing. Repeated rows link
    with each other. A null id never names a component that holds another id. An empty
    table gives an empty result; other columns are ignored.
    """
    rooted = _rooted(docs, words, percent, id_col, text_col)
    least = rooted.filter("root IS NOT NULL").groupBy("root").agg(F.min("doc_id").alias("least"))
    out = rooted.join(least, "root", "left")
    return out.select("doc_id", "n_shingles", F.when(F.col("root").isNull(), F.col("doc_id")).otherwise(F.col("least")).alias("component_id"))


def _rooted(docs: DataFrame, words: int, percent: int, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, key, n_shingles, root) per document, written: key names the row by id and
    text, root its component (null without shingles)."""
    id_, text = F.col(f"`{id_col}`"), F.col(f"`{text_col}`")
    texts = docs.select(id_.alias("doc_id"), text.alias("text"), row_key(id_, text).alias("key"))
    shingled = materialize(_shingled(texts, words), "shingled")
    members = shingled.filter("n >= 0").select("doc_id", "key", F.col("n").alias("n_shingles"), "class_hash")
    frequent = _frequent(shingled)
    classes = _classes(texts, words, percent, frequent)
    firsts = _firsts(classes)
    links = _links(texts, classes, firsts, words, percent, frequent)
    roots = components(links)
    let_go(docs.sparkSession)
    named = classes.select("c", "class_hash").join(firsts, "c").filter("c = first")
    named = named.join(roots.withColumnRenamed("node", "c"), "c", "left")
    named = named.select("class_hash", F.coalesce("root", "c").alias("root"))
    rooted = materialize(members.join(named, "class_hash", "left").drop("class_hash"), "rooted")
    discard(shingled, classes, firsts, links)
    return rooted


def near_dedup(docs: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay: of each group of near duplicates the row with the
    smallest id (null ids last). Rows are told apart by id and text: only rows that repeat
    both stay or go together. Rows without shingles stay."""
    key, = spare(docs, "key")
    judged = _rooted(docs, words, percent, id_col, text_col).filter("root IS NOT NULL")
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "key")
    best = judged.groupBy("root").agg(F.min_by("key", order).alias("best"))
    gone = judged.join(best, "root").filter("key <> best").select(F.col("key").alias(key)).distinct()
    marked = docs.withColumn(key, row_key(F.col(f"`{id_col}`"), F.col(f"`{text_col}`")))
    return marked.join(materialize(gone, "near-copies"), key, "left_anti").drop(key)
