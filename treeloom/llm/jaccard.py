"""Documents whose sets of word shingles have a Jaccard similarity of ``ALIKE`` hundredths or more.

Method. Similar documents are put in groups, and a group is known by the union of its members' tokens
(a row of the token-group matrix). A document that is similar to a member shares at least ALIKE
hundredths of its own tokens with that union, so the overlap of the two bounds all similarities in
the group at once, and only a group that reaches it is opened and compared with exactly, member by
member.

Equal sets are one. Tokens have an order, rare ones first; two similar sets share ``m`` of the first
``n - ceil(ALIKE * n / 100) + m`` of each, where m is MEET or MEET_SHARE hundredths of the smaller
(all of them, in sets of fewer). Large sets share a few by chance, so these must share more. So a set with fewer of
those that any other set of like size has goes no further, and only sets and groups that share so many are held
against each other, if their sizes and the tokens left from the first on allow it. Any order gives the same
links; it comes from counts of all tokens in SKETCH counters. Tokens that no two sets of like size have
are taken out before sets and tokens are shuffled, so what moves follows the tokens shared.

Groups are sets with the same smallest token hash, in pieces of GROUP; a set alone in its group moves nowhere. The member with the most
common tokens leads its group, and those similar to it are tied to it. For tokens that more than
CROWDED sets share, the leader of the largest class there is compared with all other sets of the
token, which ties what scatters around one text without comparing it pair by pair. Last, classes
are the groups, in pieces of GROUP, and every token brings the sets of smaller classes together
with the groups of larger ones. Sets that links already join are never compared again: the result
is classes, and a further link between two members of one changes nothing.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from treeloom.llm import words as W
from treeloom.llm.components import components
from treeloom.llm.tables import order_id, public_id, sieve, slices, spread
from treeloom.session import stage

SHINGLE = 4
ALIKE = 85
#: First tokens that similar sets must share, and hundredths of them that large sets must.
MEET, MEET_SHARE = 4, 2
#: Counters of tokens, by the low bits of their hashes.
SKETCH = 1 << 18
#: Members of a group and tokens of all of them, on average.
GROUP, GROUP_TOKENS = 128, 1 << 18
#: Counters of group keys that are split.
SPLIT = 1 << 20
#: Sets of a token above which leaders come first, and rounds of leaders.
CROWDED, ROUNDS = 32, 2
#: Queries that one copy of a group meets and their tokens, on average.
QUERIES, QUERY_TOKENS = 512, 1 << 18


def shingle_sets(texts: pa.Array, shingle: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Different shingles of each text as sorted hashes, one text after the other, and how many each has."""
    words = W.split(texts, lower=True)
    counts = words.counts
    starts = words.window_starts(shingle)
    short = np.flatnonzero((counts > 0) & (counts < shingle))
    found = np.append(words.windows(starts, shingle), words.windows(words.first[short], counts[short]))
    text = np.append(words.text_of()[starts], short)
    order = np.lexsort((found, text))
    found, text = found[order], text[order]
    new = np.ones(len(text), bool)
    new[1:] = (text[1:] != text[:-1]) | (found[1:] != found[:-1])
    return found[new], np.bincount(text[new], minlength=len(counts))


def _names(tokens: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """A hash of each set; zero without tokens."""
    out = np.zeros(len(counts), np.uint64)
    some = counts > 0
    if some.any():
        sums = np.add.reduceat(W.mix(tokens ^ np.uint64(0x5851F42D4C957F2D)), (np.cumsum(counts) - counts)[some])
        out[some] = W.mix(sums + counts[some].astype(np.uint64))
    return out.view(np.int64)


def _lists(values: np.ndarray, counts: np.ndarray) -> pa.ListArray:
    offsets = np.append(0, np.cumsum(counts)).astype(np.int32)
    return pa.ListArray.from_arrays(offsets, pa.array(values.view(np.int64)))


def _least(n: np.ndarray) -> np.ndarray:
    """Fewest tokens that a set of ``n`` shares with a similar one."""
    return -(-ALIKE * n // 100)


def _meet(n: np.ndarray) -> np.ndarray:
    """How many of a set's first tokens others may be asked to share. It never falls as sets grow."""
    return np.minimum(_least(n), np.maximum(MEET, -(-MEET_SHARE * n // 100)))


def _order(texts: DataFrame, shingle: int):
    """How often the tokens of each counter occur in all texts, as a broadcast array."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SKETCH, np.int64)
        for batch in batches:
            for part in slices(batch, "text"):
                tokens, _ = shingle_sets(part.column("text"), shingle)
                total += np.bincount((tokens & np.uint64(SKETCH - 1)).astype(np.int64), minlength=SKETCH)
        at = np.flatnonzero(total)
        yield pa.record_batch([pa.array(at), pa.array(total[at])], names=["at", "n"])

    counted = texts.select("text").mapInArrow(count, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).toArrow()
    often = np.zeros(SKETCH, np.int64)
    often[counted["at"].to_numpy()] = counted["n"].to_numpy()
    return texts.sparkSession.sparkContext.broadcast(often)


def _sets(texts: DataFrame, shingle: int) -> DataFrame:
    """``did, uid, n, prefix``: the set of each text, its size and its first tokens, rarest first."""
    often = _order(texts, shingle)

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                tokens, counts = shingle_sets(part.column("text"), shingle)
                text = np.repeat(np.arange(len(counts)), counts)
                order = np.lexsort((tokens, often.value[(tokens & np.uint64(SKETCH - 1)).astype(np.int64)], text))
                place = np.arange(len(tokens)) - (np.cumsum(counts) - counts)[text]
                first = counts - _least(counts) + _meet(counts)
                taken = tokens[order][place < first[text]]
                yield pa.record_batch(
                    [part.column("did"), pa.array(_names(tokens, counts)), pa.array(counts.astype(np.int32)), _lists(taken, first)],
                    names=["did", "uid", "n", "prefix"],
                )

    return texts.mapInArrow(sets, "did long, uid long, n int, prefix array<long>")


def _asked(n: Column) -> Column:
    """Fewest first tokens that a set of ``n`` shares with any similar one: ``_meet`` of the smallest that may be."""
    least = F.ceil(n * ALIKE / 100)
    return F.least(F.ceil(least * ALIKE / 100), F.greatest(F.lit(MEET), F.ceil(least * MEET_SHARE / 100)))


def _size_class(n: Column) -> Column:
    """The bit of a long that stands for sets of about ``n`` tokens; similar sets have the same or adjacent ones.

    Classes are a little wider than the ratio of similar sizes, so that rounding parts no pair. Bit 0 follows bit 63.
    """
    width = math.log(100 / ALIKE) + 1e-9
    return F.call_function("shiftleft", F.lit(1).cast("long"), F.floor(F.log(n) / width).cast("int") % 64)


def _beside(bits: Column) -> Column:
    """The bits on both sides of those of a long."""
    up = F.shiftleft(bits, 1).bitwiseOR(F.shiftrightunsigned(bits, 63))
    return up.bitwiseOR(F.shiftrightunsigned(bits, 1)).bitwiseOR(F.shiftleft(bits, 63))


def _shared(first: DataFrame) -> DataFrame:
    """``uid, n, at, key, sets``: first tokens that another set of like size may have, and how many sets have them.

    first: ``uid, n, at, key``. Keys are counted alone; only rows of those left then move with their sets.
    Where two sets of a key have one class of sizes, all sets of the key stay.
    """
    keys = first.groupBy("key").agg(F.count("*").alias("sets"), F.bit_or(_size_class(F.col("n"))).alias("sizes"))
    crowd = F.col("sets") > F.bit_count("sizes")
    met = F.col("sizes").bitwiseAND(_beside(F.col("sizes"))) != 0
    keys = stage(keys.filter((F.col("sets") > 1) & (crowd | met)), "keys")
    among = sieve(keys, "key")
    if among is None:
        return first.withColumn("sets", F.lit(0).cast("long")).limit(0)
    near = _size_class(F.col("n")).bitwiseAND(_beside(F.col("sizes"))) != 0
    return first.filter(among).join(keys, "key").filter(crowd | near).drop("sizes")


def _tokens(texts: DataFrame, shingle: int) -> DataFrame:
    """``uid, gkey, tokens``: the whole sets of texts and their smallest token hash; a task passes each on once."""

    def tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            for part in slices(batch, "text"):
                found, counts = shingle_sets(part.column("text"), shingle)
                names = _names(found, counts)
                new = np.zeros(len(counts), bool)
                for i, uid in enumerate(names.tolist()):
                    if counts[i] and uid not in seen:
                        seen.add(uid)
                        new[i] = True
                found, counts = found[np.repeat(new, counts)], counts[new]
                least = np.zeros(len(counts), np.uint64)
                if len(counts):
                    least = np.minimum.reduceat(W.mix(found ^ np.uint64(0xA24BAED4963EE407)), np.cumsum(counts) - counts)
                yield pa.record_batch(
                    [pa.array(names[new]), pa.array(least.view(np.int64)), _lists(found, counts)], names=["uid", "gkey", "tokens"]
                )

    return texts.select("text").mapInArrow(tokens, "uid long, gkey long, tokens array<long>")


def _grouped(tokens: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``uid, tokens, gid`` of sets that may share their group, and ``uid, gid`` of those alone in it.

    gid: the smallest token hash, and a piece of what is large.
    """
    slot = F.pmod(F.xxhash64("gkey"), F.lit(SPLIT))
    size = tokens.groupBy("gkey").agg(F.count("*").alias("n"), F.sum(F.size("tokens")).alias("total"))
    size = stage(size.filter("n > 1"), "sizes")
    several = sieve(size, "gkey")
    several = F.lit(False) if several is None else several
    size = size.select("gkey", F.ceil(F.greatest(F.col("n") / GROUP, F.col("total") / GROUP_TOKENS)).alias("pieces"))
    large = size.filter("pieces > 1").groupBy(slot.alias("slot")).agg(F.max("pieces").alias("pieces")).toArrow()
    pieces = np.ones(SPLIT, np.int64)
    pieces[large["slot"].to_numpy()] = large["pieces"].to_numpy()
    shared = tokens.sparkSession.sparkContext.broadcast(pieces)

    @F.arrow_udf("long")
    def found(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for at in batches:
            yield pa.array(shared.value[at.to_numpy(zero_copy_only=False)])

    piece = F.pmod(F.xxhash64("uid"), found(slot))
    rows = tokens.filter(several).select("uid", "tokens", F.xxhash64("gkey", piece).alias("gid"))
    return rows, tokens.filter(~several).select("uid", F.col("gkey").alias("gid"))


def _runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Consecutive rows with equal ``keys``, across batches."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
        new = np.zeros(batch.num_rows, bool)
        for c in columns:
            new[1:] |= c[1:] != c[:-1]
        here = tuple(c[0] for c in columns)
        starts = [0, *np.flatnonzero(new).tolist(), batch.num_rows]
        for a, b in zip(starts, starts[1:], strict=False):
            if held and (a or here != last):
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
        last = tuple(c[-1] for c in columns)
    if held:
        yield pa.Table.from_batches(held)


def _flat(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    lists = column.combine_chunks()
    return lists.flatten().to_numpy(), lists.value_lengths().to_numpy().astype(np.int64)


def _similar(both: np.ndarray, n: np.ndarray, m: np.ndarray | int) -> np.ndarray:
    return 100 * both >= ALIKE * (n + m - both)


def _lead(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``uid, gid, leader`` for the members of each group."""
    for group in _runs(batches, ["gid"]):
        uids, first = np.unique(group["uid"].to_numpy(), return_index=True)
        leader = np.arange(len(uids))
        if len(uids) > 1:
            flat, counts = _flat(group["tokens"].take(pa.array(first)))
            _, token, often = np.unique(flat, return_inverse=True, return_counts=True)
            starts = np.cumsum(counts) - counts
            central = np.add.reduceat(often[token], starts) / counts
            tied = np.zeros(len(uids), bool)
            for i in np.argsort(-central, kind="stable"):
                if tied[i]:
                    continue
                own = np.zeros(len(often), np.int64)
                own[token[starts[i] : starts[i] + counts[i]]] = 1
                near = _similar(np.add.reduceat(own[token], starts), counts, counts[i]) & ~tied
                near[i] = True
                leader[near], tied[near] = i, True
        gid = np.full(len(uids), group["gid"][0].as_py(), np.int64)
        yield pa.record_batch([pa.array(uids), pa.array(gid), pa.array(uids[leader])], names=["uid", "gid", "leader"])


def _merged(batches: Iterator[pa.RecordBatch], rows: int = 10_000) -> Iterator[pa.RecordBatch]:
    """The same rows in fewer batches."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if len(held) >= 500:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches(rows)
            held = []
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches(rows)


def _open(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``a, b``: queries and members that are similar, one member of each class for a query."""
    for group in _runs(batches, ["gid", "salt"]):
        member = group["member"].to_numpy(zero_copy_only=False)
        if member.all() or not member.any():
            continue
        members, queries = group.filter(pa.array(member)), group.filter(pa.array(~member))
        flat, counts = _flat(members["tokens"])
        union, token = np.unique(flat, return_inverse=True)
        starts = np.cumsum(counts) - counts
        uids, classes = members["uid"].to_numpy(), members["class"].to_numpy()
        asked, sizes = _flat(queries["tokens"])
        at = np.minimum(np.searchsorted(union, asked), len(union) - 1)
        met = union[at] == asked
        ends = np.cumsum(sizes)
        bound = np.add.reduceat(met, ends - sizes, dtype=np.int64)
        names, own_class = queries["uid"].to_numpy(), queries["class"].to_numpy()
        a, b = [], []
        for i in np.flatnonzero(bound >= _least(sizes)):
            mine = np.zeros(len(union), np.int64)
            part = slice(ends[i] - sizes[i], ends[i])
            mine[at[part][met[part]]] = 1
            near = _similar(np.add.reduceat(mine[token], starts), counts, sizes[i]) & (classes != own_class[i])
            _, one = np.unique(classes[near], return_index=True)
            b.append(uids[near][one])
            a.append(np.full(len(one), names[i]))
        if a:
            yield pa.record_batch([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], names=["a", "b"])


def _opened(pairs: DataFrame, members: DataFrame, tokens: DataFrame, classes: DataFrame) -> DataFrame:
    """``a, b``: links of the queries ``uid`` of ``pairs`` with members of the groups ``gid`` they are held against.

    members: ``gid, uid``. A group that many queries ask for is copied, a copy for about QUERIES of them.
    """
    pairs = stage(pairs.join(classes.select("uid", "class", "n"), "uid"), "pairs")
    copies = F.ceil(F.greatest(F.count("*") / QUERIES, F.sum("n") / QUERY_TOKENS))
    copies = pairs.groupBy("gid").agg(copies.alias("copies"))
    queries = pairs.join(copies, "gid").select(
        "gid", F.pmod(F.xxhash64("uid"), "copies").alias("salt"), "uid", "class", F.lit(False).alias("member")
    )
    targets = members.join(copies, "gid").join(classes.select("uid", "class"), "uid").select(
        "gid", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)).alias("salt"), "uid", "class", F.lit(True).alias("member")
    )
    asked = stage(queries.union(targets), "asked")
    needed = sieve(asked.select("uid"), "uid")
    if needed is None:
        return pairs.select(F.col("uid").alias("a"), F.col("gid").alias("b")).limit(0)
    rows = asked.join(tokens.filter(needed).drop("gkey"), "uid")
    rows = spread(rows, "gid", "salt").sortWithinPartitions("gid", "salt")
    return rows.mapInArrow(lambda batches: _merged(_open(batches)), "a long, b long")


def _classes(uids: DataFrame, links: list[DataFrame]) -> DataFrame:
    """``uid, n, class, size, gid`` of all candidates: the class with its size, and a piece of it as the group."""
    roots = components(reduce(DataFrame.union, links)).select(F.col("node").alias("uid"), F.col("root").alias("class"))
    found = uids.join(roots, "uid", "left").select("uid", "n", F.coalesce("class", "uid").alias("class"))
    pieces = F.ceil(F.greatest(F.count("*") / GROUP, F.sum("n") / GROUP_TOKENS))
    size = found.groupBy("class").agg(F.count("*").alias("size"), pieces.alias("pieces"))
    gid = F.xxhash64("class", F.pmod(F.xxhash64("uid"), "pieces"))
    return stage(found.join(size, "class").select("uid", "n", "class", "size", gid.alias("gid")), "classes")


def _below_top(rows: DataFrame) -> DataFrame:
    """``rows`` of ``key, size, class`` with ``top``, the largest class of the key, where there are two."""
    keys = rows.groupBy("key").agg(
        F.min("class").alias("one"), F.max("class").alias("other"), F.max(F.struct("size", "class")).alias("top")
    )
    return rows.join(keys.filter("one <> other").select("key", "top"), "key")


def _fit(n: Column, at: Column, n_least: Column, n_most: Column, their_at: Column, before: Column | int = 0) -> Column:
    """Whether sizes, and the tokens left from a shared one on, allow for a similar pair.

    ``before``: shared tokens that may stand before this one.
    """
    close = (100 * n_most >= ALIKE * n) & (100 * n >= ALIKE * n_least)
    return close & ((100 + ALIKE) * (F.least(n - at, n_most - their_at) + before) >= ALIKE * (n + n_least))


def _met(few: DataFrame, many: DataFrame) -> DataFrame:
    """``uid, gid, n, key, fit``: tokens that sets share with groups of larger classes, of ``few`` and of crowded tokens.

    A similar pair shares ``_asked`` tokens; the first of them fit with so many before them, and so do the
    sizes. Only such are joined, which leaves each similar pair as many as it must share.
    """
    at = [F.col("q.n"), F.col("q.at")]
    q, g = few.alias("q"), few.select("key", "class", "size", "gid", "n", "at").alias("g")
    bounds = [*at, F.col("g.n"), F.col("g.n"), F.col("g.at")]
    ranked = F.expr("struct(q.size, q.class) < struct(g.size, g.class)")
    hits = q.join(g, [F.col("q.key") == F.col("g.key"), ranked, _fit(*bounds, before=_asked(F.col("q.n")) - 1)])
    hits = hits.select("q.uid", "g.gid", "q.n", "q.key", _fit(*bounds).alias("fit"))
    q = _below_top(many).filter("struct(size, class) < top").alias("q")
    g = many.groupBy("key", "gid").agg(
        F.max(F.struct("size", "class")).alias("rank"), F.min("at").alias("at"), F.min("n").alias("n_least"), F.max("n").alias("n_most")
    ).alias("g")
    bounds = [*at, F.col("g.n_least"), F.col("g.n_most"), F.col("g.at")]
    ranked = F.expr("struct(q.size, q.class) < g.rank")
    more = q.join(g, [F.col("q.key") == F.col("g.key"), ranked, _fit(*bounds, before=_asked(F.col("q.n")) - 1)])
    return hits.union(more.select("q.uid", "g.gid", "q.n", "q.key", _fit(*bounds).alias("fit")))


def _links(prefixes: DataFrame, tokens: DataFrame) -> list[DataFrame]:
    """Links that join the same sets as all links do."""
    groups, alone = _grouped(tokens)
    groups = spread(groups, "gid").sortWithinPartitions("gid").mapInArrow(lambda b: _merged(_lead(b)), "uid long, gid long, leader long")
    groups = stage(groups.union(alone.select("uid", "gid", F.col("uid").alias("leader"))), "groups")
    uids = prefixes.select("uid", "n")
    links = [groups.filter("uid <> leader").select(F.col("uid").alias("a"), F.col("leader").alias("b"))]
    classes = _classes(uids, links)
    leaders = groups.select("uid", "leader").join(classes, "uid").groupBy("class", "leader").agg(F.count("*").alias("led"))
    leaders = stage(leaders.groupBy("class").agg(F.max_by("leader", "led").alias("leader")), "leaders")
    crowded = prefixes.select("uid", F.explode(F.filter("keys", lambda k: k["sets"] > CROWDED)).alias("k")).select("uid", "k.key")
    crowded = stage(crowded, "crowded")
    for _ in range(ROUNDS):
        rows = _below_top(crowded.join(classes, "uid")).filter("struct(size, class) < top")
        pairs = rows.select("uid", F.col("top.class").alias("class")).distinct().join(leaders, "class")
        pairs = stage(pairs.select("uid", F.col("leader").alias("gid")), "pairs")
        if pairs.isEmpty():
            break
        members = pairs.select("gid", F.col("gid").alias("uid")).distinct()
        links.append(stage(_opened(pairs, members, tokens, classes), "links"))
        classes = _classes(uids, links)

    rows = prefixes.select("uid", "keys").join(classes, "uid").select("uid", "n", "class", "size", "gid", F.explode("keys").alias("k"))
    rows = rows.select("uid", "n", "class", "size", "gid", "k.key", "k.at", (F.col("k.sets") > CROWDED).alias("crowded"))
    hits = _met(rows.filter("not crowded"), rows.filter("crowded"))
    # Members of a group that share a token with the query count it once.
    hits = hits.groupBy("uid", "gid", "key").agg(F.max("n").alias("n"), F.max("fit").alias("fit"))
    hits = hits.groupBy("uid", "gid").agg(F.count("*").alias("met"), F.max("n").alias("n"), F.max("fit").alias("fit"))
    pairs = hits.filter(F.col("fit") & (F.col("met") >= _asked(F.col("n")))).select("uid", "gid")
    links.append(stage(_opened(pairs, classes.select("gid", "uid"), tokens, classes), "links"))
    return links


def similar_documents(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE
) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every row of ``docs``.

    Words are runs of bytes other than ASCII white space, A-Z lower-cased; a document's set holds
    its different shingles, or its words as one where they are fewer. Null texts and texts without
    words have no shingle and are linked with nothing, not even their like. Rows with equal sets are
    linked whatever their ids. component_id is the smallest id that links reach; rows without an id
    come after all others and have the component of their set (null if it holds no id). Repeated
    rows come out as often as they came in. Sets and shingles are told apart by 64-bit hashes.
    Other columns are not read, whatever their names; an empty table has an empty result.
    """
    texts = docs.select(order_id(id_col).alias("did"), F.col(f"`{text_col}`").cast("string").alias("text"))
    sets = stage(_sets(texts, shingle), "sets")
    unique = sets.filter("n > 0").groupBy("uid").agg(F.min("did").alias("did"), F.first("n").alias("n"), F.first("prefix").alias("prefix"))
    unique = stage(unique, "unique")
    first = unique.select("uid", "n", F.posexplode("prefix").alias("at", "key"))
    prefixes = _shared(first).groupBy("uid").agg(
        F.max("n").alias("n"), F.collect_list(F.struct("key", "at", "sets")).alias("keys")
    )
    prefixes = stage(prefixes.filter(F.size("keys") >= _asked(F.col("n"))), "prefixes")
    ids = unique.select("uid", "did")
    needed = sieve(prefixes.select("uid").join(ids, "uid").select("did"), "did")
    if needed is None:
        roots = ids.select("uid", F.col("uid").alias("root")).limit(0)
    else:
        tokens = stage(_tokens(texts.filter(needed), shingle), "tokens")
        roots = components(reduce(DataFrame.union, _links(prefixes, tokens))).withColumnRenamed("node", "uid")
    rooted = ids.join(roots, "uid", "left").withColumn("root", F.coalesce("root", "uid"))
    least = rooted.groupBy("root").agg(F.min("did").alias("component"))
    rooted = rooted.join(least, "root").select("uid", "component")
    found = sets.select("did", "n", F.when(F.col("n") > 0, F.col("uid")).alias("uid")).join(rooted, "uid", "left")
    found = found.withColumn("component", F.coalesce("component", "did"))
    return found.select(
        public_id("did").alias("doc_id"), F.col("n").cast("long").alias("n_shingles"), public_id("component").alias("component_id")
    )
