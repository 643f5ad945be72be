"""N-gram Jaccard join by grouped prefixes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mergewell.llm.common import checkpointed
from mergewell.llm.components import components
from mergewell.llm.packing import aside, bounds, bucket_count, mixed, pack, squeeze, tidy, unpack, unsqueeze, word_keys

WORDS = 5
#: Text of one block of documents, and plan bytes for one bucket of shingles.
BLOCK_CHARS, BUCKET_BYTES = 8_000_000, 6_000_000
#: A shingle in more documents of a block than this sends its count to its bucket, and its documents straight to the block.
HOT = 64
#: Shingles travel as the first 48 bits of their hashes.
SHIFT = np.uint64(16)
#: Groups that share a shingle are paired at once up to this number; more are first compared with so many centres.
PAIRED, CENTRES = 24, 6
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)


class _Words(dict):
    """64-bit hashes of words, computed once each; emptied when large."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 300_000:
            self.clear()
        h = xxhash.xxh3_64_intdigest(word)
        if len(word) < 64:
            self[word] = h
        return h


def shingles(texts: list[str | None], words: _Words) -> tuple[np.ndarray, np.ndarray]:
    """Sorted (hash, document) of the distinct shingles of each text."""
    flat, size = word_keys(texts, words)
    start = np.concatenate([[0], np.cumsum(size)])
    owner = np.repeat(np.arange(len(size)), np.maximum(size - WORDS + 1, 0))
    first = np.arange(len(owner)) + np.repeat(start[:-1] - np.concatenate([[0], np.cumsum(np.maximum(size - WORDS + 1, 0))[:-1]]), np.maximum(size - WORDS + 1, 0))
    h = np.zeros(len(owner), np.uint64)
    for k in range(WORDS):
        h = mixed(h + flat[first + k] * _ODD[k])
    short = np.flatnonzero((size > 0) & (size < WORDS))
    brief = np.zeros(len(short), np.uint64)
    for n, d in enumerate(short):
        x = np.full(1, size[d], np.uint64)
        for k in range(size[d]):
            x = mixed(x + flat[start[d] + k : start[d] + k + 1] * _ODD[k] + np.uint64(1))
        brief[n] = x[0]
    h, owner = np.concatenate([h, brief]), np.concatenate([owner, short])
    order = np.lexsort((owner, h))
    h, owner = h[order], owner[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])
    return h[new], owner[new]


_MESSAGE = pa.schema([("bucket", pa.int32()), ("block", pa.int64()), ("keys", pa.binary()), ("counts", pa.binary()), ("docs", pa.binary()), ("about", pa.binary())])
_MESSAGE_SQL = "bucket int, block long, keys binary, counts binary, docs binary, about binary"


def _deal(buckets: int, kind: pa.DataType):
    """Blocks of documents → for each bucket the block's shingles with their documents, and a row about the block."""

    def block(number: int, ids: list, texts: list, words: _Words) -> pa.RecordBatch:
        h, owner = shingles(texts, words)
        n = np.bincount(owner, minlength=len(ids)).astype(np.uint32)
        h = h >> SHIFT
        m = mixed(h ^ _ODD[0])
        prints = np.zeros((len(ids), 2), np.uint64)
        np.add.at(prints[:, 0], owner, m)
        np.add.at(prints[:, 1], owner, mixed(m + _ODD[1]))
        new = np.ones(len(h), bool)
        new[1:] = h[1:] != h[:-1]
        at = np.flatnonzero(new)
        keys, counts = h[at], np.diff(np.append(at, len(h)))
        hot = np.repeat(counts > HOT, counts)
        cut = np.concatenate([[0], np.searchsorted(keys, edges), [len(keys)]])
        at = np.append(at, len(h))
        rows: dict[str, list] = {c: [] for c in _MESSAGE.names}
        for b in range(buckets):
            s, e = cut[b], cut[b + 1]
            if s < e:
                part = slice(at[s], at[e])
                for c, x in zip(_MESSAGE.names, (b, number, pack(keys[s:e]), counts[s:e].astype(np.uint32).tobytes(), squeeze(owner[part][~hot[part]].astype(np.uint32)), None), strict=True):
                    rows[c].append(x)
        named = pa.RecordBatch.from_arrays([pa.array(ids, kind), pa.array(n), pa.array([p.tobytes() for p in prints], pa.binary(16))], names=["id", "n", "print"])
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, named.schema) as out:
            out.write_batch(named)
        often = counts > HOT
        for c, x in zip(_MESSAGE.names, (aside(number), number, pack(keys[often]), counts[often].astype(np.uint32).tobytes(), owner[hot].astype(np.uint32).tobytes(), sink.getvalue().to_pybytes()), strict=True):
            rows[c].append(x)
        tidy()
        return pa.RecordBatch.from_pydict(rows, _MESSAGE)

    edges = bounds(buckets) >> SHIFT

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _Words()
        number = TaskContext.get().partitionId() << 32
        ids, texts, size = [], [], 0
        for batch in batches:
            for k in range(batch.num_rows):
                ids.append(batch.column(0)[k].as_py())
                texts.append(batch.column(1)[k].as_py())
                size += len(texts[-1] or "")
                if size > BLOCK_CHARS:
                    yield block(number, ids, texts, words)
                    number, ids, texts, size = number + 1, [], [], 0
        if ids:
            yield block(number, ids, texts, words)

    return run


def _rank(groups: pa.Table) -> pa.Table:
    """One bucket: finds shingles in more than one document, and answers each block with its own.

    The answer has for each such shingle its class, which grows with the
    number of documents that hold it. Rows about blocks pass through.
    """
    if groups.column("bucket")[0].as_py() < 0:
        return groups.select(["block", "keys", "counts", "docs", "about"]).append_column("classes", pa.array([None] * len(groups), pa.binary()))
    keys = [unpack(x.as_py()) for x in groups.column("keys")]
    counts = [np.frombuffer(x.as_py(), np.uint32) for x in groups.column("counts")]
    every, back = np.unique(np.concatenate(keys), return_inverse=True)
    held = np.bincount(back, weights=np.concatenate(counts), minlength=len(every))
    order = np.minimum(np.log2(held) * 2, 255).astype(np.uint8)
    out: dict[str, list] = {c: [] for c in ("block", "keys", "counts", "docs", "about", "classes")}
    at = 0
    for k, c, docs, number in zip(keys, counts, groups.column("docs"), groups.column("block"), strict=True):
        place = back[at : at + len(k)]
        at += len(k)
        shared = held[place] > 1
        own = unsqueeze(docs.as_py(), np.uint32)
        sent = np.where(c > HOT, 0, c)
        for name, x in zip(out, (number.as_py(), pack(k[shared]), c[shared].tobytes(), squeeze(own[np.repeat(shared, sent)]), None, order[place[shared]].tobytes()), strict=True):
            out[name].append(x)
    return pa.table([pa.array(out["block"], pa.int64()), *(pa.array(out[c], pa.binary()) for c in list(out)[1:])], names=list(out))


_ANSWER_SQL = "block long, keys binary, counts binary, docs binary, about binary, classes binary"


def _gather(kind: pa.DataType):
    """One block: each document with its shared shingles, the rarest first.

    A document with fewer of them than a link needs gets none.
    """

    def run(groups: pa.Table) -> pa.Table:
        rows = groups.to_pylist()
        about = next(r for r in rows if r["about"] is not None)
        named = pa.ipc.open_stream(about["about"]).read_all()
        n = named.column("n").to_numpy().astype(np.int64)
        often = unpack(about["keys"])
        lists = np.split(np.frombuffer(about["docs"], np.uint32), np.cumsum(np.frombuffer(about["counts"], np.uint32))[:-1]) if len(often) else []
        keys, classes, docs = [], [], []
        for r in rows:
            if r["about"] is None:
                k, c, cls = unpack(r["keys"]), np.frombuffer(r["counts"], np.uint32), np.frombuffer(r["classes"], np.uint8)
                few = c <= HOT
                keys.append(np.repeat(k[few], c[few]))
                classes.append(np.repeat(cls[few], c[few]))
                docs.append(unsqueeze(r["docs"], np.uint32))
                for key, one in zip(k[~few], cls[~few], strict=True):
                    own = lists[np.searchsorted(often, key)]
                    keys.append(np.full(len(own), key, np.uint64))
                    classes.append(np.full(len(own), one, np.uint8))
                    docs.append(own)
        key, cls, doc = (np.concatenate(x) if x else np.zeros(0, t) for x, t in ((keys, np.uint64), (classes, np.uint8), (docs, np.uint32)))
        shared = np.bincount(doc, minlength=len(n))
        alive = (shared >= (3 * n + 3) // 4) & (n > 0)
        mine = alive[doc]
        key, cls, doc = key[mine], cls[mine], doc[mine]
        order = np.lexsort((key, cls, doc))
        key = key[order].view(np.int64)
        at = np.concatenate([[0], np.cumsum(np.where(alive, shared, 0))])
        seen: set[bytes] = set()
        lists_out: list = []
        for d, p in enumerate(named.column("print").to_pylist()):
            lists_out.append(key[at[d] : at[d + 1]] if alive[d] and p not in seen else None)
            if alive[d]:
                seen.add(p)
        prints = [f"{int(m):08x}{p.hex()}" if a else None for m, p, a in zip(n, named.column("print").to_pylist(), alive, strict=True)]
        return pa.table([named.column("id").cast(kind), pa.array(n, pa.int64()), pa.array(prints, pa.string()), pa.array(lists_out, pa.list_(pa.int64()))], names=["doc_id", "n_shingles", "set_id", "shared"])

    return run


def shared_shingles(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, set_id, shared`` for each row of ``doc_id, text``.

    ``shared`` lists the shingles that other documents hold too, in one order
    for the whole corpus: by the number of holders (in classes), then by hash.
    Only documents that can have a link, with at least three quarters of their
    shingles shared, have a ``set_id`` (size and 128-bit fingerprint of the
    set), and only the first row of a block with that set repeats the list.
    """
    kind = docs.schema["doc_id"].dataType
    buckets = bucket_count(docs.select("doc_id", "text"), BUCKET_BYTES)
    arrow = pa.int64() if kind.simpleString() == "bigint" else pa.int32() if kind.simpleString() == "int" else pa.string()
    messages = docs.select("doc_id", "text").mapInArrow(_deal(buckets, arrow), _MESSAGE_SQL)
    answers = messages.groupBy("bucket").applyInArrow(_rank, _ANSWER_SQL)
    return answers.groupBy("block").applyInArrow(_gather(arrow), f"doc_id {kind.simpleString()}, n_shingles long, set_id string, shared array<long>")


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Of the pairs ``a, b`` of sets with their labels those that are similar enough."""
    left = sets.select(F.col("set").alias("a"), F.col("n").alias("_na"), F.col("shared").alias("_sa"))
    right = sets.select(F.col("set").alias("b"), F.col("n").alias("_nb"), F.col("shared").alias("_sb"))
    both = pairs.join(left, "a").join(right, "b").withColumn("_k", F.size(F.array_intersect("_sa", "_sb")))
    return both.where(F.col("_k") * 175 >= (F.col("_na") + F.col("_nb")) * 75).select("label_a", "label_b")


def _relabelled(labels: DataFrame, links: DataFrame) -> DataFrame:
    """Components whose labels are linked get one label."""
    found = components(links.select(F.col("label_a").alias("a"), F.col("label_b").alias("b"))).select(F.col("node").alias("label"), F.col("label").alias("_top"))
    return checkpointed(labels.join(found, "label", "left").select("set", "group", F.coalesce("_top", "label").alias("label")))


def _departures(rest: DataFrame) -> DataFrame:
    """Sets ``main, set, label, n, unique, shared`` by where they depart from what most sets of their ``main`` have.

    A departure is a shingle that only the set or only most others have. Sets
    differ in the departures that they do not share, and link if 7 times those
    are at most both sizes: 14 * common departures >= far_a + far_b, where
    ``far`` is 7 * departures - n. ``apart`` are those that other sets of the
    main have too, the rarest first. This holds for whatever is taken as
    common; the better it fits, the fewer departures there are to share.
    """
    held = rest.select("main", F.explode("shared").alias("token")).groupBy("main", "token").agg(F.count("*").alias("_held"))
    common = held.join(rest.groupBy("main").agg(F.count("*").alias("_of")), "main").where("2 * _held > _of").groupBy("main").agg(F.collect_list("token").alias("_common"))
    rows = rest.join(common, "main", "left").withColumn("_common", F.coalesce("_common", F.array().cast("array<bigint>")))
    rows = rows.withColumn("_apart", F.concat(F.array_except("shared", "_common"), F.array_except("_common", "shared")))
    rows = checkpointed(rows.select("main", "set", "label", "n", (7 * (F.size("_apart") + F.col("unique")) - F.col("n")).alias("far"), "_apart"))
    each = rows.select("main", "set", F.explode("_apart").alias("token"))
    again = each.groupBy("main", "token").agg(F.count("*").alias("_held")).where("_held > 1")
    lists = each.join(again, ["main", "token"]).groupBy("main", "set").agg(F.sort_array(F.collect_list(F.struct("_held", "token"))).alias("_apart"))
    rows = rows.drop("_apart").join(lists, ["main", "set"], "left")
    return rows.select("main", "set", "label", "n", "far", F.coalesce(F.col("_apart.token"), F.array().cast("array<bigint>")).alias("apart"))


def _to_nearest(rest: DataFrame) -> DataFrame:
    """Each set with the one of its main that departs least: sets that link without a common departure both link with that."""
    nearest = rest.groupBy("main").agg(F.min(F.struct("far", "set", "label")).alias("_c")).select("main", F.col("_c.set").alias("b"), F.col("_c.label").alias("label_b"))
    return rest.join(nearest, "main").where("label <> label_b").select(F.col("set").alias("a"), "b", F.col("label").alias("label_a"), "label_b").distinct()


def _by_departures(rest: DataFrame) -> DataFrame:
    """Pairs of sets of a main in different components that share a departure of both prefixes, and may share enough."""
    labels = rest.groupBy("main", "label").agg(F.count("*").alias("_size")).groupBy("main").agg(F.max(F.struct("_size", "label")).alias("_m"), F.count("*").alias("_labels"))
    least = rest.groupBy("main").agg(F.min("far").alias("_low")).join(labels.where("_labels > 1"), "main").select("main", "_low", F.col("_m.label").alias("most"))
    needs = F.greatest(F.ceil((F.col("far") + F.col("_low")) / 14), F.lit(1)).cast("int")
    rows = rest.join(least, "main").withColumn("size", F.size("apart")).withColumn("prefix", F.slice("apart", 1, F.greatest(F.col("size") - needs + 1, F.lit(0))))
    rows = checkpointed(rows.drop("_low", "apart"))
    sides = [rows.select("main", *(F.col(c).alias(f"{c}_{s}") for c in ("set", "label", "n", "far", "size", "prefix", "most")), F.posexplode("prefix").alias(f"at_{s}", "token")) for s in "ab"]
    # what is left of both lists from there on must do
    enough = "14 * least(size_a - at_a, size_b - at_b) >= far_a + far_b and 4 * least(n_a, n_b) >= 3 * greatest(n_a, n_b)"
    # a pair counts under the first departure of both prefixes alone
    first = "element_at(array_intersect(prefix_a, prefix_b), 1) = token"
    pairs = sides[0].where("label_a <> most_a").join(sides[1], ["main", "token"]).where(f"label_a <> label_b and (label_b = most_a or label_a < label_b) and {enough} and {first}")
    return pairs.select(F.col("set_a").alias("a"), F.col("set_b").alias("b"), "label_a", "label_b").distinct()


_CAN_LINK = "4 * least(n_a, n_b) >= 3 * greatest(n_a, n_b) and least(n_a - at_a, n_b - at_b) >= (3 * (n_a + n_b) + 6) div 7"


def link(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for each row of ``doc_id, text``.

    Two documents link if the Jaccard similarity of their sets of 5-word
    shingles is 0.75 or more; a component is all that links reach, named by
    its smallest doc_id. The join is by grouped prefixes:

    1. Shingles are dealt by hash; each comes back with a class by its number
       of holders. A set's prefix is its rarest n - ceil(0.75 n) + 1 shingles:
       linked sets share a shingle of their prefixes. Shingles of one document
       come first, so most documents have nothing to compare and end here.
    2. Equal sets are one entry. Entries of equal size and prefix are one group.
    3. Where few groups share a prefix shingle all are paired. Where many do,
       each is compared with a few centres that most lists have in common, and
       members of a group with one of them. Pairs are left out that sizes or
       the positions of the shingle exclude, the rest are verified. Thus large
       sets of near copies become one component with few comparisons.
    4. What may still be missing is exact: sets that share a prefix shingle
       but no component are described by where they depart from what most of
       them have. Each is compared with the one that departs least, and those
       that still differ in their components by a join on prefixes of their
       departures. Pairs within a component are never listed, and no link
       between components is lost.

    Null or empty text, or text of white space: 0 shingles, its own component.
    Null doc_id: takes part, never names a component with other ids. Rows that
    repeat a doc_id are separate documents. No rows, no rows. Sizes are by
    64-bit hashes of shingles, overlaps by 48 bits of them.
    """
    table = checkpointed(shared_shingles(docs))
    sets = table.where("set_id is not null").groupBy("set_id").agg(F.first("shared", ignorenulls=True).alias("shared"), F.max("n_shingles").cast("int").alias("n"), F.min("doc_id").alias("first_id"))
    unique = F.col("n") - F.size("shared")
    prefix = F.slice("shared", 1, F.greatest(F.expr("int(n - (3 * n + 3) div 4 + 1)") - unique, F.lit(0)))
    # numbers are far smaller than fingerprints; a checkpoint keeps them
    sets = checkpointed(sets.withColumn("unique", unique).withColumn("prefix", prefix).withColumn("set", F.monotonically_increasing_id()))
    # a set with a shingle of its own has a prefix of its own
    same = F.when(F.col("unique") == 0, F.sha2(F.concat_ws(":", F.col("n").cast("string"), F.array_join(F.col("prefix").cast("array<string>"), ",")), 256)).otherwise(F.col("set_id"))
    groups = sets.groupBy(same.alias("_same")).agg(F.min("set").alias("group"))
    labels = checkpointed(sets.select("set", same.alias("_same")).join(groups, "_same").select("set", "group", F.col("set").alias("label")))
    members = labels.groupBy("group").agg(F.count("*").alias("members"))
    tokens = members.join(sets.select(F.col("set").alias("group"), "n", "unique", "prefix"), "group")
    tokens = tokens.select("group", "members", "n", "unique", F.posexplode("prefix").alias("at", "token")).select("token", "group", "members", "n", (F.col("unique") + F.col("at")).alias("at"))
    # counted before the shuffle and joined back: a token of very many groups is one row on one side
    of_token = tokens.groupBy("token").agg(F.count("*").alias("held"), F.max("members").alias("most")).where("held > 1 or most > 1")
    tokens = tokens.join(of_token, "token").select("token", "group", "members", "n", "at", "held", "most")
    tokens = checkpointed(tokens)
    sides = [tokens.select("token", "held", *(F.col(c).alias(f"{c}_{s}") for c in ("group", "n", "at"))) for s in "ab"]
    few = sides[0].where(f"held <= {PAIRED}").join(sides[1].where(f"held <= {PAIRED}").drop("held"), "token").where(f"group_a < group_b and {_CAN_LINK}").select("group_a", "group_b")
    row = [F.col(c).alias(f"{c}_b") for c in ("group", "n", "at")]
    centres = tokens.where(f"held > {PAIRED}").groupBy("token").agg(*(F.min(F.struct(F.xxhash64(F.lit(c), "group").alias("_h"), *row)).alias(f"_{c}") for c in range(CENTRES)))
    centres = centres.select("token", F.explode(F.array_distinct(F.array(*(F.struct(*(F.col(f"_{c}")[f"{x}_b"].alias(f"{x}_b") for x in ("group", "n", "at"))) for c in range(CENTRES))))).alias("_c")).select("token", "_c.*")
    many = sides[0].where(f"held > {PAIRED}").join(centres, "token").where(f"group_a <> group_b and {_CAN_LINK}").select(F.least("group_a", "group_b").alias("group_a"), F.greatest("group_a", "group_b").alias("group_b"))
    heads = few.unionByName(many).distinct().toDF("a", "b")
    inside = labels.where("set <> group").select(F.col("group").alias("a"), F.col("set").alias("b"))
    pairs = heads.unionByName(inside).select("a", "b", F.col("a").alias("label_a"), F.col("b").alias("label_b"))
    labels = _relabelled(labels, checkpointed(_verified(pairs, sets)))

    # long lists, and groups of several members: by the largest component of a shingle, which names what they have in common
    units = labels.select("group", "label").distinct()
    rest = tokens.where(f"held > {PAIRED} or most > 1").select("token", "group").join(units, "group")
    size = rest.groupBy("token", "label").agg(F.count("*").alias("_size")).groupBy("token").agg(F.max(F.struct("_size", "label")).alias("_m"), F.count("*").alias("_labels"))
    rest = rest.join(size.where("_labels > 1").select("token", F.col("_m.label").alias("main")), "token").select("main", "group", "label").distinct()
    rest = checkpointed(rest.join(labels, ["group", "label"]).select("main", "set", "label").join(sets.select("set", "n", "unique", "shared"), "set"))
    if not rest.isEmpty():
        rest = checkpointed(_departures(rest))
        for found in (_to_nearest, _by_departures):
            links = checkpointed(_verified(found(rest), sets))
            if not links.isEmpty():
                labels = _relabelled(labels, links)
                rest = rest.drop("label").join(labels.select("set", "label"), "set")

    final = sets.select("set", "set_id", "first_id").join(labels, "set")
    names = final.groupBy("label").agg(F.min("first_id").alias("component_id"))
    final = final.join(names, "label").select("set_id", "component_id")
    return table.join(final, "set_id", "left").select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))
