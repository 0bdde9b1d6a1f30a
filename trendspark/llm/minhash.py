"""Near-duplicate detection: MinHash, banding, verification, alternating stars.

1. Every text becomes the set of its word shingles; equal sets are one node from here on.
2. Many universal hash minima make a signature; its bands put nodes into buckets.
3. Candidates are pairs of one bucket: each member with the smallest one, and all members of a small
   bucket. A first round verifies one candidate of each node. Further candidates count only between
   components that are still apart; their signatures are compared before their sets.
   What a large bucket leaves in several components is compared block by block, so that no link is lost
   and no task holds a whole bucket.
4. Links, confirmed on full sets, become components by alternating large-star and small-star.

Defined cases: a null text is empty; texts without words link with nothing; rows with equal
sets share a component; a row without doc_id goes by a hash of its text; rows that share
a doc_id are one document: the links of each of its texts are its links; an empty table
gives an empty result; columns other than doc_id and text are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import node_id, released, ship, stored, text_nodes, texts

SHINGLE, PERCENT = 4, 80
BANDS, ROWS = 26, 5
#: Buckets up to this size give all their pairs at once.
SMALL_BUCKET = 8
#: Nodes, and characters, in a block of a large bucket.
BLOCK, BLOCK_CHARS = 256, 8 << 20
#: Signatures of linked sets agree in at least this share of places, but for one pair in about 10^6.
SIGNATURE_SHARE = 0.62
MEMO = 300_000
#: Up to this many links (16 bytes each) are turned into stars by one task.
FEW_LINKS = 1 << 17

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


class WordHashes(dict):
    """64-bit hash of a word; remembers up to ``MEMO`` words."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= MEMO:
            self.clear()
        self[word] = found = xxhash.xxh3_64_intdigest(word)
        return found


def hashed_words(found: list[str], hashes: WordHashes) -> list[np.ndarray]:
    """Hashes of the words of each text, in order; A-Z lower-cased. Of a word that comes often one is made."""
    split = pc.ascii_split_whitespace(pc.ascii_lower(pa.array(found, pa.large_string())))
    coded = split.flatten().dictionary_encode()
    known = coded.dictionary.cast(pa.large_binary()).to_pylist()
    of_word = np.array([hashes[x] for x in known], "u8")
    index = coded.indices.to_numpy()
    words = of_word[index] if len(known) else np.empty(0, "u8")
    bounds = split.offsets.to_numpy()
    # White space at an end of a text leaves an empty word there.
    empty = known.index(b"") if b"" in known else -1
    out = []
    for start, end in zip(bounds, bounds[1:], strict=False):
        start, end = int(start), int(end)
        start += start < end and index[start] == empty
        end -= start < end and index[end - 1] == empty
        out.append(words[start:end])
    return out


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit numbers over all bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def runs(words: np.ndarray, length: int) -> np.ndarray:
    """Hash of the ``length`` words from each place (there are as many at least), by joining blocks of 1, 2, 4, ..."""
    block, size = words, 1
    total, done = None, 0
    while True:
        if length & size:
            if total is None:
                total = block
            else:  # this block goes in front of what is there
                n = len(words) - (done + size) + 1
                total = block[:n] * _power(done) + total[size : size + n]
            done += size
        if done == length:
            return mixed(total)
        block = block[: len(block) - size] * _power(size) + block[size:]
        size *= 2


def _power(exponent: int) -> np.uint64:
    return np.uint64(pow(int(_MULTIPLIER), exponent, 1 << 64))


def shingles(text: str, hashes: WordHashes, size: int = SHINGLE) -> np.ndarray:
    """Sorted hashes of the distinct word shingles; words are runs of other than ASCII white space, A-Z lower-cased."""
    words = text.encode("utf-8", "replace").lower().split()
    if not words:
        return np.empty(0, "u8")
    found = np.array([hashes[x] for x in words], "u8")
    if len(found) < size:
        return mixed(runs(found, len(found)) + np.uint64(len(found)))
    return np.unique(runs(found, size))


def linked(a: np.ndarray, b: np.ndarray) -> bool:
    small, large = sorted((len(a), len(b)))
    if not small or 100 * small < PERCENT * large:
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= PERCENT * (len(a) + len(b) - both)


def hash_family(n: int) -> tuple[np.ndarray, np.ndarray]:
    chance = np.random.default_rng(7)
    return chance.integers(0, 1 << 31, n, "u4") * np.uint32(2) + np.uint32(1), chance.integers(0, 1 << 32, n, "u4")


def signature(items: np.ndarray) -> np.ndarray:
    """Minima of a * x + b (32 bits) over the set, for each of the hash functions."""
    a, b = hash_family(BANDS * ROWS)
    x = (items ^ (items >> np.uint64(32))).astype("u4")
    least = np.full(len(a), 0xFFFFFFFF, "u4")
    for start in range(0, len(x), 2048):
        part = x[start : start + 2048]
        np.minimum(least, (part[:, None] * a + b).min(axis=0), out=least)
    return least


@released
def _signatures(frames: Iterator[pd.DataFrame], shingle: int) -> Iterator[pd.DataFrame]:
    hashes = WordHashes()
    for frame in frames:
        sizes, digests, signatures = [], [], []
        for text in frame["text"]:
            items = shingles(text, hashes, shingle)
            sizes.append(len(items))
            digests.append(xxhash.xxh3_128_digest(items.tobytes()) if len(items) else None)
            signatures.append(signature(items).astype("<u4").tobytes() if len(items) else None)
        yield frame.drop(columns="text").assign(n_shingles=sizes, digest=digests, signature=signatures)


def band_keys(signatures: np.ndarray) -> np.ndarray:
    """The bucket of each band (columns) of signatures (rows)."""
    table = signatures.reshape(len(signatures), BANDS, ROWS).astype("u8")
    keys = np.zeros((len(signatures), BANDS), "u8") + np.arange(BANDS, dtype="u8")
    for i in range(ROWS):
        keys = mixed(keys * _MULTIPLIER + table[:, :, i])
    return keys


@released
def _bands(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        keys = band_keys(np.frombuffer(b"".join(frame["signature"]), "<u4").reshape(len(frame), BANDS * ROWS))
        yield pd.DataFrame({"bucket": keys.ravel().view("i8"), "node": np.repeat(frame["node"].to_numpy(), BANDS)})


def _alike(a: pd.Series, b: pd.Series) -> np.ndarray:
    one, two = (np.frombuffer(b"".join(x), "<u4").reshape(len(x), -1) for x in (a, b))
    return (one == two).mean(axis=1) >= SIGNATURE_SHARE


@released
def _verified(frames: Iterator[pd.DataFrame], shingle: int) -> Iterator[pd.DataFrame]:
    hashes = WordHashes()
    for frame in frames:
        last, items = None, None
        keep = []
        for a, one, two in zip(frame["a"], frame["text_a"], frame["text_b"], strict=True):
            if a != last:
                last, items = a, shingles(one, hashes, shingle)
            keep.append(linked(items, shingles(two, hashes, shingle)))
        yield frame.loc[keep, ["a", "b"]]


def verify(pairs: DataFrame, bodies: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """Those pairs (a, b) whose full sets are linked."""
    first = bodies.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    second = bodies.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    joined = pairs.join(second, "b").join(first, "a")
    told = joined.select("a", "b", "text_a", "text_b")
    return stored(told.mapInPandas(lambda frames: _verified(frames, shingle), "a long, b long"), "links")


def components(links: DataFrame) -> DataFrame:
    """node, component (smallest node reachable) of every node in ``links`` (columns a, b).

    Large-star links the larger neighbours of each node to its smallest one, small-star the smaller
    ones; both in turn until the links stay as they are. Minima are aggregated before they are dealt out and
    stored, so that a join on a node with very many neighbours can be split. Up to ``FEW_LINKS`` links are not
    dealt out at all.
    """
    low, high = F.least("a", "b").alias("v"), F.greatest("a", "b").alias("u")
    edges = stored(links.select(high, low).filter("u <> v").distinct(), "edges")
    few = edges.count() <= FEW_LINKS

    def kept(df: DataFrame, name: str) -> DataFrame:
        return stored(df, name).coalesce(1) if few else stored(df, name)

    edges = edges.coalesce(1) if few else edges
    while True:
        both = edges.select(F.explode(F.array(F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v")))).alias("e"))
        least = kept(both.groupBy(F.col("e.u").alias("u")).agg(F.least(F.min("e.v"), F.col("u")).alias("m")), "least")
        large = kept(
            both.select("e.u", "e.v").filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(),
            "large",
        )
        least = kept(large.groupBy("u").agg(F.min("v").alias("m")), "least")
        moved = large.join(least, "u")
        small = kept(
            moved.select(F.explode(F.array(F.struct("v", "m"), F.struct(F.col("u").alias("v"), "m"))).alias("e"))
            .select(F.col("e.v").alias("u"), F.col("e.m").alias("v"))
            .filter("u <> v")
            .distinct(),
            "small",
        )
        if _sum(small) == _sum(edges):
            break
        edges = small
    heads = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(heads)


def merged(found: DataFrame, links: DataFrame) -> DataFrame:
    """The components ``found`` after further ``links`` (a, b); a node that is in none is one of its own.

    Only the links are turned into stars again, between the components that they join.
    """
    ends = stored(_known(links, found), "ends")
    again = components(ends.select(F.coalesce("of_a", "a").alias("a"), F.coalesce("of_b", "b").alias("b")))
    again = stored(again.select(F.col("node").alias("old"), F.col("component").alias("new")), "again")
    new = [F.struct(F.col(x).alias("node"), F.col(f"of_{x}").alias("component")) for x in ("a", "b")]
    new = ends.select(F.explode(F.array(*new)).alias("e")).filter("e.component IS NULL")
    rows = found.unionByName(new.select("e.node", F.col("e.node").alias("component")).distinct())
    joined = rows.join(again, F.col("component") == F.col("old"), "left")
    return joined.select("node", F.coalesce("new", "component").alias("component"))


def _sum(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v") % 1_000_003)).first())


def _known(pairs: DataFrame, found: DataFrame) -> DataFrame:
    """Pairs with the components of their ends, null for a node in none."""
    of = lambda name: found.select(F.col("node").alias(name), F.col("component").alias(f"of_{name}"))
    return pairs.join(of("a"), "a", "left").join(of("b"), "b", "left").select("a", "b", "of_a", "of_b")


def _apart(pairs: DataFrame, found: DataFrame) -> DataFrame:
    """Pairs whose ends are not yet in one component."""
    return _known(pairs, found).filter(~(F.coalesce("of_a", "a") == F.coalesce("of_b", "b"))).select("a", "b")


def _block_links(key: tuple, one: pd.DataFrame, two: pd.DataFrame, shingle: int) -> pd.DataFrame:
    """Links between a block of nodes outside the leading component and any block of the same bucket.

    A pair is taken up in the first of the buckets that hold both, and only if its signatures are alike; one
    link of a node with a component is enough.
    """
    out = []
    if len(one) and len(two):
        x, y = (np.frombuffer(b"".join(z["signature"]), "<u4").reshape(len(z), -1) for z in (one, two))
        band = int(np.flatnonzero(band_keys(x[:1])[0].view("i8") == key[0])[0])
        ids, parts, outside = two["node"].to_numpy("i8"), two["component"].to_numpy("i8"), two["outside"].to_numpy(bool)
        bodies, hashes, sets = two["text"].tolist(), WordHashes(), {}
        for node, component, text, mine in zip(one["node"], one["component"], one["text"], x, strict=True):
            agree = y == mine
            share = agree.mean(axis=1)
            near = (share >= SIGNATURE_SHARE) & (parts != component) & (~outside | (ids > node))
            near &= ~agree.reshape(len(y), BANDS, ROWS).all(axis=2)[:, :band].any(axis=1)
            found, met = None, set()
            for at in sorted(np.flatnonzero(near).tolist(), key=lambda k: -share[k]):
                if parts[at] in met:
                    continue
                found = shingles(text, hashes, shingle) if found is None else found
                if at not in sets:
                    sets[at] = shingles(bodies[at], hashes, shingle)
                if linked(found, sets[at]):
                    met.add(parts[at])
                    out.append((min(node, int(ids[at])), max(node, int(ids[at]))))
    return pd.DataFrame(out, columns=["a", "b"]).astype("i8")


def _left_over(
    members: DataFrame, found: DataFrame, signatures: DataFrame, bodies: DataFrame, shingle: int
) -> DataFrame:
    """Links between components that share a large bucket, verified block by block; no pair leaves a task unverified.

    Each block of nodes outside the bucket's leading component meets each block of its nodes.
    """
    known = members.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    known = known.join(bodies.select("node", F.length("text").alias("chars")), "node")
    sizes = known.groupBy("bucket", "component").agg(F.count(F.lit(1)).alias("n"), F.sum("chars").alias("chars"))
    blocks = lambda n, chars: F.ceil(F.greatest(n / BLOCK, chars / BLOCK_CHARS)).cast("long")
    leads = (
        sizes.groupBy("bucket")
        .agg(
            F.max(F.struct("n", F.negative("component").alias("c"), "chars")).alias("top"),
            F.count(F.lit(1)).alias("parts"),
            F.sum("n").alias("n"),
            F.sum("chars").alias("chars"),
        )
        .filter("parts > 1")
        .select(
            "bucket",
            F.negative("top.c").alias("lead"),
            blocks(F.col("n"), F.col("chars")).alias("all_blocks"),
            blocks(F.col("n") - F.col("top.n"), F.col("chars") - F.col("top.chars")).alias("outer_blocks"),
        )
    )
    rows = known.drop("chars").join(stored(leads, "leads"), "bucket").join(signatures, "node").join(bodies, "node")
    rows = rows.withColumn("outside", F.col("component") != F.col("lead"))
    number = lambda n: F.pmod(F.xxhash64("node"), F.greatest(F.col(n), F.lit(1)))
    upto = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.col(n), F.lit(1)) - 1))
    columns = ["bucket", "i", "j", "node", "component", "outside", "signature", "text"]
    left = rows.filter("outside").withColumn("i", number("outer_blocks")).withColumn("j", upto("all_blocks"))
    again = rows.select(*[F.col(c).alias(c) for c in rows.columns])  # columns of its own for the second side
    right = again.withColumn("j", number("all_blocks")).withColumn("i", upto("outer_blocks"))
    keys = ["bucket", "i", "j"]
    met = left.select(*columns).groupBy(*keys).cogroup(right.select(*columns).groupBy(*keys))
    links = met.applyInPandas(lambda key, one, two: _block_links(key, one, two, shingle), "a long, b long")
    return links.distinct()


def _pairs(one: Column, two: Column) -> list[Column]:
    return [F.least(one, two).alias("a"), F.greatest(one, two).alias("b")]


def _same_document(signed: DataFrame, sets: DataFrame) -> DataFrame:
    """Links (a, b) between the sets of texts that share a doc_id."""
    own = signed.select("home", "digest", (F.col("node") == F.col("home")).alias("first")).join(sets, "digest")
    further = stored(own.filter("NOT first").select("home", F.col("node").alias("b")).distinct(), "further")
    first = own.filter("first").select("home", F.col("node").alias("a"))
    return first.join(further, "home").filter("a <> b").select(*_pairs(F.col("a"), F.col("b"))).distinct()


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, n_shingles, component_id, kept, node of every row; sets are of ``shingle`` words."""
    ship(docs.sparkSession)
    rows = text_nodes(texts(docs, F.col("doc_id").cast("long").alias("doc_id"), node_id().alias("node")))
    made = rows.withColumn("content", F.xxhash64("text")).mapInPandas(
        lambda frames: _signatures(frames, shingle),
        "home long, doc_id long, node long, content long, n_shingles long, digest binary, signature binary",
    )
    made = made.select("doc_id", "home", "node", "content", "n_shingles", "digest", "signature")
    signed = stored(made, "signatures")
    sets = stored(
        signed.filter(F.col("digest").isNotNull()).groupBy("digest").agg(F.min("node").alias("node")), "sets"
    )
    joint = stored(_same_document(signed, sets), "joint")
    one_set = sets.groupBy("node").agg(F.min(F.hex("digest")).alias("hexed")).select(
        "node", F.unhex("hexed").alias("digest")
    )
    heads = stored(signed.join(one_set, ["node", "digest"]).select("node", "content", "signature"), "heads")
    bands = heads.select("node", "signature").mapInPandas(_bands, "bucket long, node long").distinct()
    bands = stored(bands, "bands")
    buckets = bands.groupBy("bucket").agg(F.count(F.lit(1)).alias("size"), F.min("node").alias("low"))
    members = stored(bands.join(stored(buckets.filter("size > 1"), "buckets"), "bucket"), "members")
    candidates = members.select("node").distinct()
    chosen = heads.join(candidates, "node", "left_semi").groupBy("node").agg(F.min("content").alias("content"))
    chosen = stored(chosen, "chosen")
    body = rows.select("node", "text", F.xxhash64("text").alias("content"))
    bodies = body.join(chosen.hint("shuffle_hash"), ["node", "content"], "left_semi").dropDuplicates(["node"])
    bodies = stored(bodies.select("node", "text"), "bodies")
    signatures = stored(
        heads.join(candidates, "node", "left_semi").select("node", "signature").dropDuplicates(["node"]), "candidates"
    )

    # First round: each node with the bucket head it shares most buckets with.
    stars = (
        members.filter("node <> low")
        .groupBy("node", "low")
        .agg(F.count(F.lit(1)).alias("shared"))
    )
    stars = stored(stars, "stars")
    best = stars.groupBy("node").agg(F.max(F.struct("shared", F.negative("low").alias("l"))).alias("top"))
    links = verify(best.select(*_pairs(F.col("node"), F.negative("top.l"))), bodies, shingle).unionByName(joint)
    found = stored(components(links), "components")

    # Second round: all candidates between components that are still apart.
    small = members.filter(F.col("size") <= SMALL_BUCKET).select("bucket", "node")
    inner = small.join(small.withColumnRenamed("node", "other"), "bucket").filter("node < other")
    pairs = stars.select(*_pairs(F.col("node"), F.col("low"))).unionByName(
        inner.select(*_pairs(F.col("node"), F.col("other")))
    )
    apart = _apart(pairs.distinct(), found)
    of = lambda name: signatures.select(F.col("node").alias(name), F.col("signature").alias(f"s_{name}"))

    @released
    def alike(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield frame.loc[_alike(frame["s_a"], frame["s_b"]), ["a", "b"]] if len(frame) else frame[["a", "b"]]

    likely = apart.join(of("b"), "b").join(of("a"), "a").mapInPandas(alike, "a long, b long")
    more = verify(likely, bodies, shingle)
    if not more.isEmpty():
        found = stored(merged(found, more), "components")

    # What large buckets still leave apart.
    large = members.filter(F.col("size") > SMALL_BUCKET).select("bucket", "node")
    rest = stored(_left_over(large, found, signatures, bodies, shingle), "rest")
    if not rest.isEmpty():
        found = stored(merged(found, rest), "components")

    of_sets = sets.join(found, "node", "left").select(
        F.col("digest"), F.coalesce("component", "node").alias("component")
    )
    joined = signed.select("doc_id", "home", "node", "n_shingles", "digest").join(
        stored(of_sets, "of_sets"), "digest", "left"
    )
    component = F.coalesce("component", F.col("home"))
    # A component can be named by a further text's node if the first one has no words.
    odd = stored(
        joined.filter("node <> home").groupBy("component").agg(F.min("home").alias("least")).filter("least < component"),
        "odd",
    )
    named = joined.join(odd.withColumnRenamed("component", "of"), F.col("component") == F.col("of"), "left")
    name = F.coalesce("least", component)
    return named.select(
        "doc_id", "n_shingles", name.alias("component_id"), (F.col("home") == name).alias("kept"), F.col("home").alias("node")
    )
