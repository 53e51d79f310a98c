"""N-gram Jaccard join with a token-group matrix.

Documents are sets of distinct word n-grams (64-bit hashes). Equal sets are one
class, known by a digest and named by its least doc_id.

1. Kept tokens. A set's prefix, in the order of the hashes, leaves out what every
   partner must share but for ``shared(size)`` tokens, so two sets within the
   threshold have that many of the smaller one's tokens in both prefixes. Of these
   each set drops its ``dropped`` most frequent ones, so ``bound(size)`` shared tokens,
   the least frequent of them, stay on both sides. A passage that many documents
   carry makes no candidates, and none is lost. A token that one prefix only has
   finds nobody and goes too; so do sets that keep fewer tokens than the bound.
2. Groups. The sets that are left are dealt out by range of their least kept tokens,
   which near copies share. A set goes to a group with the same one that has half of its
   kept tokens, up to ``GROUP_TOKENS`` tokens, or to a new one; such parts of
   several tasks are put together afterwards. A group's row of the matrix is the union of its members' kept tokens and the range
   of their sizes.
3. Bound. A set's kept tokens are counted against the unions; only a group that holds
   as many as the set must share with a member of a fitting size is opened for it.
   Chains of such counts mean nothing: a set meets the groups it may have a partner in.
4. Opened groups. A task holds one group at a time, its tokens as one list with the
   places they stand in, and streams through it the sets that open it. The overlaps
   with all members are counted at once, on whole sets made again from the texts. Where
   the set links to the first of every part of the group that hangs together already,
   the rest need no counting. A task gives a spanning forest of the links it finds.

Tokens in one of a hundred classes or more (found per slice, so a bounded list) take
no part in the shuffle that counts tokens; they count as the most frequent.

Defined cases. NULL text or no words: empty set, no links. Fewer words than n:
the whole sequence is one token. NULL doc_id: n_shingles only, no links and a
NULL component. Rows that share a doc_id are one node of the links (not in
``apply`` by text). Empty table: empty result. Very long texts are read whole.
Other columns are not read (``apply`` keeps them).
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ballotbox.llm.common import WORD, materialize, pieces, text_key
from ballotbox.llm.components import components
from ballotbox.llm.suffixes import hashes, sums

N, PERCENT = 4, 85
BOUND = 5                   # kept tokens that partners share (all they must share, if that is fewer)
SHARED, SMALL = 4, 64       # prefixes share one in so many of the set's tokens, and all they must up to so many
HOT_SHARE = 100             # a token in one of so many classes is hot
MOST = 1 << 30              # what a hot token counts as
RUN = 1 << 16               # rows up to which a token's are counted
GROUP_TOKENS = 1 << 19      # of the members of a group (one member at least)
GROUP = 4_096               # members of a group
GOING = 16                  # groups with the same least token that a set is tried with
FIRSTS = 8                  # parts of a group whose first members are tried before the group is opened
PART = 1 << 20              # bytes hashed at a time

_space = np.zeros(256, dtype=bool)
_space[[32, 9, 10, 11, 12, 13]] = True


def word_hashes(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the words of all parts in one pass over their bytes, and where each
    part's words start and end. Words lie between the six white-space bytes of the
    word pattern."""
    b = np.frombuffer(b"\n".join(parts) + b"\n", np.uint8)
    offsets = np.cumsum([0, *(len(p) + 1 for p in parts)])[:-1]
    blank = _space[b]
    edge = np.flatnonzero(blank[1:] != blank[:-1]) + 1
    if not blank[0]:
        edge = np.concatenate([[0], edge])
    start, stop = edge[0::2], edge[1::2]
    first = np.searchsorted(start, offsets)
    out, i = np.empty(len(start), np.uint64), 0
    while i < len(start):           # a very long text goes in parts, cut between words
        j = max(i + 1, int(np.searchsorted(stop, start[i] + PART, "right")))
        at = start[i]
        out[i:j] = hashes(sums(b[at:stop[j - 1]]), start[i:j] - at, stop[i:j] - at)
        i = j
    return out, first, np.append(first[1:], len(start))


def shingle_sets(texts: list[str | None], n: int = N) -> list[np.ndarray]:
    """Sorted distinct token hashes (int64) of each text, lower-cased A-Z only."""
    w, first, last = word_hashes([(t or "").encode("utf-8", "surrogatepass").lower() for t in texts])

    def folded(words: np.ndarray, size: int) -> np.ndarray:
        h = np.full(max(0, len(words) - size + 1), size, np.uint64)
        for k in range(size):
            h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + words[k:len(words) - size + 1 + k]
        h = (h ^ (h >> np.uint64(30))) * np.uint64(0x94D049BB133111EB)
        return (h ^ (h >> np.uint64(31))).view(np.int64)

    every, out = folded(w, n), []
    for a, z in zip(first.tolist(), last.tolist()):
        if z - a >= n:
            out.append(np.unique(every[a:z - n + 1]))
        else:
            out.append(folded(w[a:z], z - a) if z > a else np.empty(0, np.int64))
    return out


def digest(tokens: np.ndarray) -> bytes:
    return hashlib.blake2b(tokens.tobytes(), digest_size=16).digest()


def least_shared(size: int, percent: int = PERCENT) -> int:
    """Tokens that a set of this size shares with any partner."""
    return -(-percent * size // 100)


def shared(size: int, percent: int = PERCENT) -> int:
    """Of those, the ones to be found in both prefixes (of the smaller set)."""
    return min(least_shared(size, percent), max(SMALL, -(-size // SHARED)))


def dropped(size: int, percent: int = PERCENT) -> int:
    """The most frequent tokens that a set of this size leaves out of its prefix: with any
    partner it shares ``BOUND`` more in both prefixes (if it must share so many at all)."""
    return max(0, shared(least_shared(size, percent), percent) - BOUND)      # of the smallest partner


def prefix(tokens: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    return tokens[:len(tokens) - least_shared(len(tokens), percent) + shared(len(tokens), percent)]


def _members(docs: DataFrame, n: int) -> DataFrame:
    """doc_id, txt_key, size, digest of every row."""
    def rows(batches):
        for batch in pieces(batches, 2 << 20):
            sets = shingle_sets(batch.column("text").to_pylist(), n)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("txt_key"), pa.array(map(len, sets), pa.int64()),
                 pa.array([digest(s) for s in sets], pa.binary())], names=["doc_id", "txt_key", "size", "digest"])

    return docs.mapInArrow(rows, "doc_id long, txt_key long, size long, digest binary")


def _classes(docs: DataFrame, n: int, percent: int) -> DataFrame:
    """digest, ref (the least one), size, prefix of every distinct set."""
    kind = docs.schema["ref"].dataType.simpleString()

    def rows(batches):
        for batch in pieces(batches, 2 << 20):
            sets = shingle_sets(batch.column("text").to_pylist(), n)
            yield pa.RecordBatch.from_arrays(
                [batch.column("ref"), pa.array(map(len, sets), pa.int64()), pa.array([digest(s) for s in sets], pa.binary()),
                 pa.array([prefix(s, percent) for s in sets], pa.list_(pa.int64()))], names=["ref", "size", "digest", "prefix"])

    found = docs.filter("doc_id IS NOT NULL").select("ref", "text").mapInArrow(
        rows, f"ref {kind}, size long, digest binary, prefix array<bigint>").filter("size > 0")
    return found.groupBy("digest").agg(F.min("ref").alias("ref"), F.first("size").alias("size"), F.first("prefix").alias("prefix"))


def _hot(classes: DataFrame) -> np.ndarray:
    """Tokens in at least one of ``HOT_SHARE`` classes of some slice and of one of
    twice as many overall, sorted: at most 2 x ``HOT_SHARE`` prefixes' worth."""
    def count(batches):
        for batch in batches:
            tokens, n = np.unique(batch.column("prefix").flatten().to_numpy(), return_counts=True)
            often = n * HOT_SHARE >= max(batch.num_rows, 10 * HOT_SHARE)
            yield pa.RecordBatch.from_arrays([pa.array(tokens[often]), pa.array(n[often])], names=["token", "n"])

    least = classes.count() / (2 * HOT_SHARE)
    found = (classes.select("prefix").mapInArrow(count, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))
             .filter(F.col("n") >= least).select("token").collect())
    return np.sort(np.array([r[0] for r in found], dtype=np.int64))


def _tokens(classes: DataFrame, percent: int) -> DataFrame:
    """token, node, size of the prefix tokens by which candidates are found."""
    holder = classes.sparkSession.sparkContext.broadcast(_hot(classes))

    def split(batches):
        hot = holder.value
        for batch in batches:
            lists = batch.column("prefix")
            tokens, of = lists.flatten().to_numpy(), np.repeat(np.arange(batch.num_rows), lists.value_lengths().to_numpy())
            is_hot = np.zeros(len(tokens), bool)
            if len(hot):
                is_hot = hot[np.minimum(np.searchsorted(hot, tokens), len(hot) - 1)] == tokens
            for start in range(0, len(tokens), 1 << 18):
                part = slice(start, start + (1 << 18))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(tokens[part]), pa.array(batch.column("node").to_numpy()[of[part]]),
                     pa.array(batch.column("size").to_numpy()[of[part]]), pa.array(is_hot[part])], names=["token", "node", "size", "hot"])

    def counted(batches):
        """Rows in order of the token: those whose token comes again, with its number
        of rows (up to ``RUN``, so that a long run needs no more memory)."""
        most, held, size, going = RUN, [], 0, None       # going: a token whose first rows are out already

        def done(rows, last):
            nonlocal going
            token = rows.column("token").to_numpy()
            cut = np.flatnonzero(token[1:] != token[:-1]) + 1
            start, stop = np.concatenate([[0], cut]), np.concatenate([cut, [len(token)]])
            ready = len(token) if last or len(start) == 1 else start[-1]     # the last run may go on
            n = np.repeat(stop - start, stop - start)
            n[token == going] = most
            going = token[0] if len(start) == 1 else None
            again = np.flatnonzero((n > 1)[:ready])
            out = pa.RecordBatch.from_arrays(
                [pa.array(token[again]), pa.array(rows.column("node").to_numpy()[again]), pa.array(rows.column("size").to_numpy()[again]),
                 pa.array(np.minimum(n[again], most))], names=["token", "node", "size", "often"])
            return out, rows.slice(ready) if ready < len(token) else None

        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            if size >= 4 * most:
                out, rest = done(pa.Table.from_batches(held), False)
                yield out
                held = rest.to_batches() if rest is not None else []
                size = sum(b.num_rows for b in held)
        if size:
            yield done(pa.Table.from_batches(held), True)[0]

    rows = classes.select("node", "size", "prefix").mapInArrow(split, "token long, node long, size long, hot boolean")
    cold = (rows.filter("NOT hot").select("token", "node", "size").repartition("token").sortWithinPartitions("token")
            .mapInArrow(counted, "token long, node long, size long, often long"))
    every = cold.union(rows.filter("hot").select("token", "node", "size", F.lit(MOST).cast("long")))
    smallest = F.ceil(F.col("size") * percent / 100)
    share = F.least(F.ceil(smallest * percent / 100), F.greatest(F.lit(SMALL), F.ceil(smallest / SHARED)))
    gone = F.greatest(F.lit(0), share - BOUND)
    order = Window.partitionBy("node", "size").orderBy(F.desc("often"), F.desc("token"))
    return every.withColumn("at", F.row_number().over(order)).filter(F.col("at") > gone).select("token", "node", "size")


def _grouped(tokens: DataFrame, percent: int) -> DataFrame:
    """node, size, kept, group, low, high: the sets that keep enough tokens, in groups of
    neighbours by their least kept tokens."""
    sets = (tokens.groupBy("node", "size").agg(F.sort_array(F.collect_list("token")).alias("kept"))      # one set's tokens
            .filter(F.size("kept") >= F.least(F.lit(BOUND), F.ceil(F.ceil(F.col("size") * percent / 100) * percent / 100))))
    ordered = (sets.withColumn("first", F.element_at("kept", 1)).repartitionByRange("first", "node")
               .sortWithinPartitions("first", "kept", "node").select("node", "size", "kept"))

    def cut(batches):
        first = None
        going: dict[int, list] = {}     # first member -> union of kept tokens, members, tokens of the members
        for batch in batches:
            out = np.empty(batch.num_rows, np.int64)
            for i, (node, size, kept) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("node", "size", "kept")))):
                if kept[0] != first:
                    first, going = kept[0], {}
                for g, held in going.items():
                    if 2 * len(held[0].intersection(kept)) >= len(kept):
                        break
                else:
                    g, held = node, [set(), 0, 0]
                    going[g] = held
                    if len(going) > GOING:
                        del going[next(iter(going))]
                held[0].update(kept)
                held[1:] = held[1] + 1, held[2] + size
                if held[1] >= GROUP or held[2] >= GROUP_TOKENS:
                    del going[g]
                out[i] = g
            yield pa.RecordBatch.from_arrays([batch.column("node"), batch.column("size"), batch.column("kept"), pa.array(out)],
                                             names=["node", "size", "kept", "part"])

    cuts = materialize(ordered.mapInArrow(cut, "node long, size long, kept array<bigint>, part long"), "jaccard-parts", 4)
    # parts of different tasks are one group, as far as its size goes, if the least two
    # tokens that half of their members keep are the same
    parts = cuts.groupBy("part").agg(F.sum("size").alias("tokens"), F.count("*").alias("held"))
    core = (cuts.select("part", F.explode("kept").alias("token")).groupBy("part", "token").agg(F.count("*").alias("n"))
            .join(parts, "part").filter(F.col("n") * 2 >= F.col("held")).groupBy("part", "tokens")
            .agg(F.xxhash64(F.slice(F.sort_array(F.collect_list("token")), 1, 2)).alias("sign")))
    upto = Window.partitionBy("sign").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    groups = (core.withColumn("before", F.coalesce(F.sum("tokens").over(upto), F.lit(0)))
              .select("part", F.xxhash64("sign", F.floor(F.col("before") / GROUP_TOKENS)).alias("group")))
    return cuts.join(groups, "part").drop("part")


def _openings(sets: DataFrame, percent: int) -> DataFrame:
    """node, group: the groups that each set opens. Of two groups the one with fewer members
    asks (of two as large, the one with the lesser number), so what few sets a large group
    of near copies has left outside asks it, and not the other way round."""
    stats = sets.groupBy(F.col("group").alias("open")).agg(F.min("size").alias("low"), F.max("size").alias("high"), F.count("*").alias("held"))
    own = stats.select(F.col("open").alias("group"), F.col("held").alias("own"))
    rows = sets.select("node", "size", "group", F.explode("kept").alias("token")).join(own, "group")
    matrix = rows.select("token", F.col("group").alias("open")).distinct().join(stats, "open")
    asks = (F.col("own") < F.col("held")) | ((F.col("own") == F.col("held")) & (F.col("group") < F.col("open")))
    fits = asks & (F.col("size") * percent <= F.col("high") * 100) & (F.col("low") * percent <= F.col("size") * 100)
    met = rows.join(matrix, "token").filter(fits).groupBy("node", "size", "open", "low").agg(F.count("*").alias("n"))
    smaller = F.least("size", F.greatest("low", F.ceil(F.col("size") * percent / 100)))
    return (met.filter(F.col("n") >= F.least(F.lit(BOUND), F.ceil(smaller * percent / 100)))
            .select("node", F.col("open").alias("group")))


def _texts(docs: DataFrame, wanted: DataFrame, n: int) -> DataFrame:
    """node, packed (text) of the classes in ``wanted`` (node, ref, digest). A packed text
    is a third of its set of hashes, so texts travel and sets are made where they
    are compared."""
    kind = docs.schema["ref"].dataType.simpleString()

    def packed(batches):
        press = zstandard.ZstdCompressor(level=1)
        for batch in pieces(batches, 4 << 20):
            yield pa.RecordBatch.from_arrays(
                [batch.column("ref"), pa.array([press.compress((t or "").encode("utf-8", "surrogatepass"))
                                                for t in batch.column("text").to_pylist()], pa.binary())], names=["ref", "packed"])

    small = docs.filter("doc_id IS NOT NULL").select("ref", "text").mapInArrow(packed, f"ref {kind}, packed binary")
    joined = small.join(wanted, "ref").select("node", "digest", "packed")

    def rows(batches):
        for batch in pieces(batches, 1 << 20, column="packed"):
            right = [digest(s) == want for s, want in zip(_unpacked(batch, n), batch.column("digest").to_pylist())]
            yield batch.select(["node", "packed"]).filter(pa.array(right, pa.bool_()))

    return joined.mapInArrow(rows, "node long, packed binary")


def _unpacked(batch: pa.RecordBatch, n: int) -> list[np.ndarray]:
    press = zstandard.ZstdDecompressor()
    return shingle_sets([press.decompress(p).decode("utf-8", "surrogatepass") for p in batch.column("packed").to_pylist()], n)


class _Group:
    """The members of an opened group: their tokens as one list, and which of them hang
    together by links found so far (``label``: the first member of the part)."""

    def __init__(self, nodes: np.ndarray, sets: list[np.ndarray], percent: int):
        self.nodes, self.sets, self.percent = nodes, sets, percent
        self.sizes = np.array([len(s) for s in sets])
        tokens, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), self.sizes)
        order = np.argsort(tokens, kind="stable")
        tokens, self.owner = tokens[order], owner[order]
        self.union, self.first = np.unique(tokens, return_index=True)
        self.last = np.append(self.first[1:], len(tokens))
        self.label = np.arange(len(sets))

    def _links(self, tokens: np.ndarray, member: int) -> bool:
        own = self.sets[member]
        at = np.minimum(np.searchsorted(own, tokens), len(own) - 1)
        both = int((own[at] == tokens).sum())
        return 100 * both >= self.percent * (len(own) + len(tokens) - both)

    def _opened(self, tokens: np.ndarray) -> np.ndarray:
        """All members that the set links to."""
        at = np.minimum(np.searchsorted(self.union, tokens), len(self.union) - 1)
        at = at[self.union[at] == tokens]
        if len(at) < least_shared(len(tokens), self.percent):
            return at[:0]
        counts = self.last[at] - self.first[at]
        places = np.repeat(self.first[at] - np.concatenate([[0], np.cumsum(counts)[:-1]]), counts) + np.arange(counts.sum())
        both = np.bincount(self.owner[places], minlength=len(self.sets))
        return np.flatnonzero(100 * both >= self.percent * (len(tokens) + self.sizes - both))

    def parts(self, tokens: np.ndarray, firsts: list[int], upto: int | None = None) -> list[int]:
        """First members of the parts (of the members before ``upto``) that the set links to."""
        if len(firsts) <= FIRSTS and all(self._links(tokens, m) for m in firsts):
            return firsts
        hit = self._opened(tokens)
        return np.unique(self.label[hit if upto is None else hit[hit < upto]]).tolist()

    def join(self, parts: list[int]) -> None:
        self.label[np.isin(self.label, parts)] = parts[0]

    def own_links(self):
        """Links that hold the members together."""
        firsts: list[int] = []
        for m, tokens in enumerate(self.sets):
            parts = self.parts(tokens, firsts, m) if firsts else []
            yield from ((self.nodes[m], self.nodes[p]) for p in parts)
            if parts:
                self.label[m] = parts[0]
                self.join(parts)
                firsts = [f for f in firsts if f not in parts[1:]]
            else:
                firsts.append(m)
        self.firsts = firsts

    def links_of(self, node: int, tokens: np.ndarray):
        parts = self.parts(tokens, self.firsts)
        yield from ((node, self.nodes[p]) for p in parts)
        if len(parts) > 1:
            self.join(parts)
            self.firsts = [f for f in self.firsts if f not in parts[1:]]


def _linked(placed: DataFrame, n: int, percent: int) -> DataFrame:
    """a, b: a spanning forest of the links in each group and of the sets that open it.
    ``placed``: group, opens, node, packed; a task holds the members of one group and
    the sets that open it come after them, some at a time."""
    def unpacked(held: list[bytes]) -> list[np.ndarray]:
        press = zstandard.ZstdDecompressor()
        return shingle_sets([press.decompress(p).decode("utf-8", "surrogatepass") for p in held], n)

    def out(found):
        a, b = zip(*found)
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    def compare(batches):
        number, members, group = None, [], None
        for batch in pieces(batches, 1 << 20, column="packed"):
            names, opens, nodes, packed = (batch.column(c).to_pylist() for c in ("group", "opens", "node", "packed"))
            sets, found = unpacked(packed), []
            for g, is_query, node, tokens in zip(names, opens, nodes, sets):
                if g != number:
                    if group is None and len(members) > 1:
                        found += _Group(*_columns(members), percent).own_links()
                    number, members, group = g, [], None
                if not is_query:
                    members.append((node, tokens))
                    continue
                if group is None:
                    group = _Group(*_columns(members), percent)
                    found += group.own_links()
                found += group.links_of(node, tokens)
            if found:
                yield out(found)
        if group is None and len(members) > 1 and (found := list(_Group(*_columns(members), percent).own_links())):
            yield out(found)

    return placed.repartition("group").sortWithinPartitions("group", "opens").mapInArrow(compare, "a long, b long")


def _columns(members: list[tuple]) -> tuple[np.ndarray, list[np.ndarray]]:
    return np.array([m[0] for m in members], np.int64), [m[1] for m in members]


def _links(docs: DataFrame, classes: DataFrame, n: int, percent: int) -> DataFrame:
    """a, b: links by which the nodes of ``classes`` (node, ref, digest, size, prefix) reach all their partners."""
    sets = materialize(_grouped(_tokens(classes, percent), percent), "jaccard-sets", 4)
    opened = materialize(_openings(sets, percent), "jaccard-openings", 8)
    # members of groups that are opened or have several; sets that open one
    busy = (opened.select("group").union(sets.groupBy("group").count().filter("count > 1").select("group"))).distinct()
    placed = (sets.select("group", "node").join(busy, "group", "left_semi").withColumn("opens", F.lit(False))
              .unionByName(opened.select("group", "node").withColumn("opens", F.lit(True))))
    placed = materialize(placed, "jaccard-placed", 8)
    wanted = classes.select("node", "ref", "digest").join(placed.select("node").distinct(), "node", "left_semi")
    texts = materialize(_texts(docs, wanted, n), "jaccard-texts", 3)
    return materialize(_linked(placed.join(texts, "node").select("group", "opens", "node", "packed"), n, percent), "jaccard-links", 4)


def groups(docs: DataFrame, n: int = N, percent: int = PERCENT) -> DataFrame:
    """doc_id, txt_key, n_shingles, component_id of every row. Classes are numbered and
    linked by their sets first; a doc_id with several texts then links theirs, so an id
    that very many rows share is a key of joins only."""
    docs = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumn("txt_key", text_key(F.col("text")))
            .withColumn("ref", F.struct("doc_id", "txt_key")))
    members = materialize(_members(docs.drop("ref"), n), "jaccard-members")
    classes = materialize(_classes(docs, n, percent).withColumn("node", F.monotonically_increasing_id()), "jaccard-classes", 3)
    tree = components(_links(docs, classes, n, percent))
    named = classes.select("digest", "node").join(tree, "node", "left").select("digest", F.coalesce("component", "node").alias("part"))
    parts = materialize(members.filter("size > 0 AND doc_id IS NOT NULL").join(named, "digest").select("doc_id", "part").distinct(),
                        "jaccard-parts-of", 4)
    least = parts.groupBy("doc_id").agg(F.min("part").alias("least"))
    also = parts.join(least, "doc_id").filter("part <> least").select(F.col("least").alias("a"), F.col("part").alias("b"))
    whole = least.select("doc_id", F.col("least").alias("whole"))
    if not also.isEmpty():
        whole = whole.join(components(also), F.col("whole") == F.col("node"), "left").select(
            "doc_id", F.coalesce("component", "whole").alias("whole"))
    names = whole.join(whole.groupBy("whole").agg(F.min("doc_id").alias("component_id")), "whole").select("doc_id", "component_id")
    return (members.join(names, "doc_id", "left")
            .select("doc_id", "txt_key", F.col("size").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id")))


def report(docs: DataFrame) -> DataFrame:
    return groups(docs).select("doc_id", "n_shingles", "component_id")


def apply(docs: DataFrame, n: int = N, percent: int = PERCENT, by_text: bool = False) -> DataFrame:
    """One document of each group stays, the one with the least doc_id (and text
    key); rows without a doc_id stay. With ``by_text`` rows that share a doc_id but
    not a text are documents of their own, linked by their sets only, and rows
    without words stay too; without it a doc_id keeps one row."""
    if by_text:
        return _apart(docs, n, percent)
    keep = (groups(docs, n, percent).filter(F.col("doc_id") == F.col("component_id"))
            .groupBy("doc_id").agg(F.min("txt_key").alias("_keep_key")).withColumnRenamed("doc_id", "_keep_id"))
    stay = docs.join(keep, docs["doc_id"] == keep["_keep_id"]).filter(text_key(docs["text"]) == F.col("_keep_key"))
    one = stay.dropDuplicates(["_keep_id"]).select(*[docs[c] for c in docs.columns])
    return one.unionByName(docs.filter(docs["doc_id"].isNull()))


def _apart(docs: DataFrame, n: int, percent: int) -> DataFrame:
    """``apply`` by text: classes are numbered and known by their least (doc_id, text key)."""
    rows = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
            .withColumn("ref", F.struct("doc_id", text_key(F.col("text")).alias("txt_key"))))
    classes = materialize(_classes(rows, n, percent).withColumn("node", F.monotonically_increasing_id()), "jaccard-classes", 3)
    tree = components(_links(rows, classes, n, percent))
    keep = (classes.select("node", "ref").join(tree, "node", "left").groupBy(F.coalesce("component", "node")).agg(F.min("ref").alias("ref"))
            .select(F.col("ref.doc_id").alias("_keep_id"), F.col("ref.txt_key").alias("_keep_key")))
    stay = docs.join(keep, (docs["doc_id"] == keep["_keep_id"]) & (text_key(docs["text"]) == keep["_keep_key"]))
    one = stay.dropDuplicates(["_keep_id", "_keep_key"]).select(*[docs[c] for c in docs.columns])
    return one.unionByName(docs.filter(docs["doc_id"].isNull() | ~F.coalesce(docs["text"], F.lit("")).rlike(WORD)))
