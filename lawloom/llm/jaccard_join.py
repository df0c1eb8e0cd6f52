"""N-gram Jaccard join by prefix trees.

1. Documents with equal sets become one class; the smallest id stands for it.
2. Each set is dealt by hash to more cells than the tokens in which similar sets can
   differ, so such sets have an equal cell. A set that shares no cell can have no link.
   The cells are compared among all documents, then among those that stand for the
   classes left. Only the texts of these go on.
3. Their distinct word shingles are put in one global order: by how frequent their
   counter is, then by hash. Two sets with the required similarity share tokens at
   their beginnings, which gives the places where they must meet. Classes whose
   beginning shares too few tokens with any other class are dropped, too.
4. Every class left has a home: the commonest of its shared tokens that are not much more
   common than its middle one, so that copies of one text have few homes between them.
   A home with many classes is cut into parts of about `home_size`, and two of its
   classes are put into every part, to tie the parts together. A prefix tree over each part finds its links; subtrees that are
   already connected or cannot reach the similarity are passed over.
5. Homes that still hold different components, and share enough tokens, are compared:
   the classes of the smaller one visit the prefix tree of the larger, in parts again.

So all links count, but not all pairs of a group of copies are looked at, and no
task ever holds a whole group. Links become components by star contraction.

Frequency is a sum over the documents left in a fixed number of counters (`COUNTERS`). The
counters only decide the order, so collisions in them cost time, not links.

Defined results: a null or wordless text has an empty set and no links; a text shorter
than a shingle is one shingle; rows with the same id are one document, linked together;
rows with a null id are returned with a null component; an empty table gives an empty
result; only doc_id and text are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lawloom.llm.common import broadcast_if_small, forget, map_texts, staged
from lawloom.llm.components import connected_components
from lawloom.llm.hashing import hash_words, mix64, shingle_sets, text_chunks
from lawloom.llm.packing import join_packed, pack, runs
from lawloom.llm.prefix_tree import links_among, links_between

#: Shingle counters for the global order: one number each reaches the driver and all tasks.
COUNTERS = 1 << 18
#: Survivor ids, with a place or two each, known to fit a broadcast (at most 40 bytes a row).
MAX_BROADCAST_IDS = 200_000
#: Rounds of dropping sets that share too little; each is cheaper than the one before.
ROUNDS = 2
#: Text whose cells go to one part, and text whose cells a task deals together, about.
PART_BYTES, DEALT_BYTES = 1 << 25, 1 << 24
#: Bits of a cell's name; a collision costs time, no link.
CELL_BITS = 48
#: Bits that mark the ids whose texts are read again; a collision costs time, no link.
MARKS = 1 << 26
#: Extra beginning, in percent of a set, that similar sets must also share in part.
EXTRA_PERCENT = 3


def _sets(batch: pa.RecordBatch, words_per_shingle: int):
    """(ids, texts, hashes) per chunk: rows of `texts` number the documents of the chunk."""
    ids, column = batch.column(0), batch.column(1)
    for first, end, data, offsets in text_chunks(column):
        texts, hashes = shingle_sets(hash_words(data, offsets), words_per_shingle)
        yield ids.slice(first, end - first), np.bincount(texts, minlength=end - first), texts, hashes


def _sums(texts: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """Sum of the values of each of n texts, the texts being in order."""
    out = np.zeros(n, dtype=np.uint64)
    first, _ = runs(texts)
    if len(first):
        out[texts[first]] = np.add.reduceat(values, first)
    return out


def _levels(largest: int, percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(smallest size of each level, tokens in which similar sets of it can differ, cells of a set).

    Of two similar sets the larger one is of the level of the smaller one, or of the next.
    A level has cells for its own sets and for those of the level before. Without a
    token to differ in, similar sets are equal and need no cells.
    """
    low = [1]
    while low[-1] <= largest:
        low.append(max(low[-1] + 1, 100 * (low[-1] - 1) // percent + 1))
    low.append(max(low[-1] + 1, 100 * (low[-1] - 1) // percent + 1))
    low.append(max(low[-1] + 1, 100 * (low[-1] - 1) // percent + 1))
    low = np.array(low, dtype=np.int64)
    differ = (100 - percent) * 2 * (low[1:] - 1) // (100 + percent)
    return low[:-1], differ, np.where(differ > 0, differ + 2 + differ // 16, 0)


def set_cells(counts: np.ndarray, texts: np.ndarray, hashes: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """(text, name) of the cells of each set: similar sets that are not equal have one in common.

    A set has so many cells more than similar sets can differ in that an equal one is
    not empty, unless a set has as many empty ones; then these have names, too.
    """
    low, differ, cells = _levels(int(counts.max(initial=0)), percent)
    own = np.searchsorted(low, counts, "right") - 1
    mixed = mix64(hashes ^ mix64(np.full(1, 0xC3, dtype=np.uint64)))
    found_texts, found = [], []
    for level in (own, own + 1):
        k = np.where(counts > 0, cells[level], 0)
        first = np.cumsum(k) - k
        dealt = k[texts] > 0
        text = texts[dealt]
        cell = first[text] + ((hashes[dealt] >> np.uint64(32)) * k[text].astype(np.uint64) >> np.uint64(32)).astype(np.int64)
        sums, filled = np.zeros(k.sum(), dtype=np.uint64), np.zeros(k.sum(), dtype=bool)
        np.add.at(sums, cell, mixed[dealt])
        filled[cell] = True
        of_text = np.repeat(np.arange(len(k)), k)
        empty = np.bincount(of_text[~filled], minlength=len(k))
        named = filled | (empty >= k - differ[level])[of_text]
        of_text = of_text[named]
        place = (np.arange(len(named))[named] - first[of_text]).astype(np.uint64)
        names = mix64(sums[named] + mix64(place << np.uint64(20) | level[of_text].astype(np.uint64)))
        found_texts.append(of_text)
        found.append(names >> np.uint64(64 - CELL_BITS))
    return np.concatenate(found_texts), np.concatenate(found)


_DEALT = "part long, cells binary, owners binary, doc_id long, n long, s1 long, s2 long"
#: Parts of rows that are no cells.
_DIGEST, _SHARING = -1, -2


def _dealt_rows(part, doc_id=None, cells=None, owners=None, digest=(None, None, None)) -> pa.RecordBatch:
    n = len(part)
    columns = [part, cells, owners, doc_id, *digest]
    types = [pa.int64(), pa.binary(), pa.binary(), *[pa.int64()] * 4]
    arrays = [pa.nulls(n, t) if c is None else c if isinstance(c, pa.Array) else pa.array(c, t) for c, t in zip(columns, types, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, ["part", "cells", "owners", "doc_id", "n", "s1", "s2"])


def _shared_cells(cells: np.ndarray, owners: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distinct cells, one owner of each, distinct owners of cells that several ids have)."""
    order = np.argsort(cells)
    cells, owners = cells[order], owners[order]
    first, end = runs(cells)
    if not len(first):
        return cells, owners, owners
    least = np.minimum.reduceat(owners, first)
    several = least < np.maximum.reduceat(owners, first)
    return cells[first], least, np.unique(owners[np.repeat(several, end - first)])


def deal_cells(docs: DataFrame, words_per_shingle: int, percent: int, parts: int) -> DataFrame:
    """Digests of all sets, in one pass with their cells by part.

    Rows of part _DIGEST have doc_id, n, s1 and s2: size of each set and two 64-bit sums
    that name it. Rows of part _SHARING have a doc_id that shares a cell with another one
    in what a task deals together. The others have cells, and one owner of each.
    """

    def dealt(cells: list, owners: list):
        names, owner, sharing = _shared_cells(np.concatenate(cells), np.concatenate(owners))
        yield _dealt_rows(np.full(len(sharing), _SHARING), sharing)
        part = names * np.uint64(parts) >> np.uint64(CELL_BITS)
        first, end = runs(part)
        blobs = [[pack(x[a:b]) for a, b in zip(first, end, strict=True)] for x in (names, owner)]
        yield _dealt_rows(part[first].astype(np.int64), None, *blobs)

    def deal(batches):
        cells, owners, size = [], [], 0
        for batch in batches:
            for ids, counts, texts, hashes in _sets(batch, words_per_shingle):
                sums = [
                    _sums(texts, mix64(hashes ^ mix64(np.full(1, salt, dtype=np.uint64))), len(counts)).view(np.int64)
                    for salt in (0x51, 0xA7)
                ]
                yield _dealt_rows(np.full(len(counts), _DIGEST), ids, digest=(counts.astype(np.int64), *sums))
                named = ids.is_valid().to_numpy(zero_copy_only=False)
                own = ids.fill_null(0).to_numpy()
                of_text, names = set_cells(np.where(named, counts, 0), texts[named[texts]], hashes[named[texts]], percent)
                cells.append(names)
                owners.append(own[of_text])
            size += batch.column(1).nbytes
            if size > DEALT_BYTES:
                yield from dealt(cells, owners)
                cells, owners, size = [], [], 0
        if cells:
            yield from dealt(cells, owners)

    return map_texts(docs.select("doc_id", "text"), deal, _DEALT)


def sharing_ids(dealt: DataFrame) -> DataFrame:
    """(live_id): distinct ids of sets that share a cell with a set of another id."""

    def meet(group: pa.Table) -> pa.Table:
        owners = join_packed(group["owners"]).view(np.int64)
        return pa.table({"live_id": _shared_cells(join_packed(group["cells"]), owners)[2]})

    met = dealt.filter("part >= 0").select("part", "cells", "owners").groupBy("part").applyInArrow(meet, "live_id long")
    return met.unionByName(dealt.filter(F.col("part") == _SHARING).select(F.col("doc_id").alias("live_id"))).distinct()


def texts_of(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """Distinct (doc_id, text) of the ids in the column `live_id`.

    Marks of the ids are sent to all tasks, so that only these texts are shuffled.
    """
    per_row = 1 << 16

    def marks(group: pa.Table) -> pa.Table:
        at = group["mark"].to_numpy() % per_row
        found = np.zeros(per_row, dtype=np.uint8)
        found[at] = 1
        return pa.table({"slot": group["slot"][:1], "marks": pa.array([np.packbits(found).tobytes()], pa.binary())})

    marked = np.zeros(MARKS // 8, dtype=np.uint8)
    mark = F.pmod(F.xxhash64("live_id"), F.lit(MARKS))
    slots = ids.select(mark.alias("mark")).distinct().withColumn("slot", F.floor(F.col("mark") / per_row))
    for row in slots.groupBy("slot").applyInArrow(marks, "slot long, marks binary").collect():  # at most MARKS / per_row rows
        marked[row["slot"] * per_row // 8 : (row["slot"] + 1) * per_row // 8] = np.frombuffer(row["marks"], dtype=np.uint8)
    sent = docs.sparkSession.sparkContext.broadcast(marked)

    def choose(batches):
        for batch in batches:
            at = batch.column(2).to_numpy()
            hit = sent.value[at >> 3] >> (7 - (at & 7)).astype(np.uint8) & 1
            yield batch.select(["doc_id", "text"]).filter(pa.array(hit.astype(bool)))

    some = map_texts(docs.select("doc_id", "text", F.pmod(F.xxhash64("doc_id"), F.lit(MARKS)).alias("mark")), choose, "doc_id long, text string")
    return some.join(ids, F.col("doc_id") == F.col("live_id"), "left_semi").distinct()


def shingle_counts(docs: DataFrame, words_per_shingle: int) -> np.ndarray:
    """How many documents' shingles fall to each of COUNTERS counters."""

    def count(batches):
        counts = np.zeros(COUNTERS, dtype=np.int64)
        for batch in batches:
            for _, _, _, hashes in _sets(batch, words_per_shingle):
                counts += np.bincount((hashes % np.uint64(COUNTERS)).astype(np.int64), minlength=COUNTERS)
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(counts[used])], ["counter", "n"])

    counted = map_texts(docs.select("doc_id", "text"), count, "counter long, n long")
    total = np.zeros(COUNTERS, dtype=np.int64)
    for row in counted.groupBy("counter").agg(F.sum("n").alias("n")).collect():  # at most COUNTERS rows
        total[row["counter"]] = row["n"]
    return total


def set_beginnings(docs: DataFrame, words_per_shingle: int, percent: int, counts_of: np.ndarray) -> DataFrame:
    """(doc_id, n, token): the first tokens of each set, as many as the similarity needs."""

    def beginnings(batches):
        for batch in batches:
            for ids, counts, texts, hashes in _sets(batch, words_per_shingle):
                frequency = counts_of[(hashes % np.uint64(COUNTERS)).astype(np.int64)]
                order = np.lexsort((hashes, frequency, texts))
                first = np.concatenate(([0], np.cumsum(counts)))
                position = np.arange(len(texts)) - first[texts]
                n = counts[texts]
                length = n - (percent * n + 99) // 100 + 1 + EXTRA_PERCENT * n // 100
                keep = position < length
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.take(pa.array(texts[keep])),
                        pa.array(n[keep], pa.int32()),
                        pa.array(hashes[order][keep].view(np.int64)),
                    ],
                    ["doc_id", "n", "token"],
                )

    return map_texts(docs.select("doc_id", "text"), beginnings, "doc_id long, n int, token long")


def whole_sets(docs: DataFrame, words_per_shingle: int) -> DataFrame:
    """(doc_id, tokens): each set as the bytes of its hashes, ascending."""

    def whole(batches):
        for batch in batches:
            for ids, counts, _, hashes in _sets(batch, words_per_shingle):
                first = np.concatenate(([0], np.cumsum(counts)))
                tokens = [hashes[a:b].tobytes() for a, b in zip(first[:-1], first[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([ids, pa.array(tokens, pa.binary())], ["doc_id", "tokens"])

    return map_texts(docs.select("doc_id", "text"), whole, "doc_id long, tokens binary")


def _still_shared(rows: DataFrame, percent: int) -> DataFrame:
    """Staged rows of tokens found in two documents or more, of documents with enough such tokens.

    The given staged rows are deleted: they are the largest table here.

    A partner has at least `percent` of this set's size, so its beginning holds at least
    the tokens counted here, and similar sets share all of those.
    """
    shared = (
        rows.groupBy(F.col("token").alias("shared_token"))
        .agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"))
        .filter("low < high")
        .select("shared_token")
    )
    alive = staged(rows.join(shared, F.col("token") == F.col("shared_token")).drop("shared_token"), "shared", True)
    forget(rows)
    partner = F.expr(f"({percent} * n + 99) div 100")
    needed = (F.lit(EXTRA_PERCENT) * partner / 100).cast("long") + 1
    enough = (
        alive.groupBy(F.col("doc_id").alias("live_id"), F.col("n").alias("live_n"))
        .agg(F.count("*").alias("alive"))
        .withColumn("n", F.col("live_n"))
        .filter(F.col("alive") >= needed)
        .select("live_id", "live_n")
    )
    same = (F.col("doc_id") == F.col("live_id")) & (F.col("n") == F.col("live_n"))
    left = staged(alive.join(enough, same).drop("live_id", "live_n"), "alive", True)
    forget(alive)
    return left


def _decode(column: pa.ChunkedArray) -> list[np.ndarray]:
    return [np.frombuffer(v.as_py(), dtype=np.uint64) for v in column]


_LINKS = "a long, b long"


def _as_links(found: list[tuple[int, int]]) -> pa.Table:
    pairs = np.array(found, dtype=np.int64).reshape(-1, 2)
    return pa.table({"a": pairs[:, 0], "b": pairs[:, 1]})


def _parts(docs: DataFrame) -> int:
    size = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    return min(int(size // PART_BYTES) + 1, 1 << (64 - CELL_BITS))


def link_sets(
    docs: DataFrame, digests: DataFrame, sharing: DataFrame, words_per_shingle: int, percent: int, home_size: int
) -> tuple[DataFrame, DataFrame]:
    """(digests with `rep`, links between representatives a and b) of the documents' sets."""
    docs = docs.filter(F.col("doc_id").isNotNull())
    digests = digests.filter("n > 0 AND doc_id IS NOT NULL")
    classes = digests.groupBy("n", "s1", "s2").agg(F.min("doc_id").alias("rep"))
    digest_of = digests.join(
        classes.select(*[F.col(c).alias(f"c_{c}") for c in ("n", "s1", "s2")], F.col("rep")),
        (F.col("n") == F.col("c_n")) & (F.col("s1") == F.col("c_s1")) & (F.col("s2") == F.col("c_s2")),
    )

    # only the representative of each class goes on
    found = digest_of.join(sharing, F.col("doc_id") == F.col("live_id"), "left_semi")
    reps = staged(found.select(F.col("rep").alias("rep_id"), F.col("n").alias("rep_n")).distinct(), "reps", True)
    live = staged(texts_of(docs, reps.select(F.col("rep_id").alias("live_id")).distinct()), "live", True)
    again = staged(deal_cells(live, words_per_shingle, percent, _parts(live)), "cells", True)  # without the copies
    still = staged(sharing_ids(again), "sharing", True)
    texts = staged(live.join(still, F.col("doc_id") == F.col("live_id"), "left_semi"), "live", True)
    forget(live)
    forget(again)
    forget(still)

    counts_of = shingle_counts(texts, words_per_shingle)
    beginnings = staged(set_beginnings(texts, words_per_shingle, percent, counts_of), "beginnings", True)
    is_rep = (F.col("doc_id") == F.col("rep_id")) & (F.col("n") == F.col("rep_n"))
    alive = staged(beginnings.join(reps, is_rep, "left_semi"), "alive", True)
    forget(beginnings)
    for _ in range(1 + ROUNDS):  # what one round drops can leave others alone
        alive = _still_shared(alive, percent)

    ids = staged(alive.select(F.col("doc_id").alias("live_id")).distinct(), "live-ids", True)
    live = texts.join(ids, F.col("doc_id") == F.col("live_id"), "left_semi")
    sets = staged(whole_sets(live, words_per_shingle).distinct(), "sets", True)
    forget(texts)

    # home: of the tokens about as common as most of the set's, the commonest, and a part of it
    common = alive.groupBy(F.col("token").alias("t")).agg(F.count("*").alias("df"))
    ranked = (
        alive.select("doc_id", "token").join(common, F.col("token") == F.col("t"))
        .groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("df", "token"))).alias("tokens"))
    )
    middle = F.get("tokens", F.floor(F.size("tokens") / 2).cast("int"))["df"]
    usual = ranked.select("doc_id", "tokens", middle.alias("middle"))
    first = usual.select(
        "doc_id", F.array_max(F.filter("tokens", lambda t: t["df"] * 4 <= F.col("middle") * 5))["token"].alias("home")
    )
    crowd = first.groupBy(F.col("home").alias("crowd")).agg(
        F.ceil(F.count("*") / home_size).cast("int").alias("parts"),
        F.min("doc_id").alias("tie_low"),
        F.max("doc_id").alias("tie_high"),
    )
    part = F.pmod(F.xxhash64("doc_id"), F.col("parts")).cast("int")
    homes = staged(
        first.join(crowd, F.col("home") == F.col("crowd")).select(
            "doc_id", "home", part.alias("part"), "parts", F.col("doc_id").isin(F.col("tie_low"), F.col("tie_high")).alias("tie")
        ),
        "homes",
        True,
    )
    everywhere = F.sequence(F.lit(0), F.col("parts") - 1)
    members = homes.withColumn("part", F.explode(F.when(F.col("tie"), everywhere).otherwise(F.array("part"))))

    def within(group: pa.Table) -> pa.Table:
        return _as_links(links_among(group["doc_id"].to_numpy(), _decode(group["tokens"]), percent))

    links = staged(
        sets.join(broadcast_if_small(members.select("doc_id", "home", "part"), MAX_BROADCAST_IDS), "doc_id")
        .groupBy("home", "part").applyInArrow(within, _LINKS),
        "links-within",
        True,
    )

    # homes whose classes are not connected yet
    component = connected_components(links)
    placed = staged(
        homes.join(component, F.col("doc_id") == F.col("node"), "left").select(
            "doc_id", "home", "part", F.coalesce("component", "doc_id").alias("component")
        ),
        "placed",
        True,
    )
    sizes = alive.groupBy("doc_id").agg(F.min("n").alias("n"))
    needed = (F.lit(EXTRA_PERCENT) * F.expr(f"({percent} * n + 99) div 100") / 100).cast("long") + 1
    per_home = (
        placed.join(sizes.select(F.col("doc_id").alias("sized"), needed.alias("needed")), F.col("doc_id") == F.col("sized"))
        .groupBy("home", "part")
        .agg(
            F.count("*").alias("crowd"),
            F.min("needed").alias("needed"),
            F.min("component").alias("c_low"),
            F.max("component").alias("c_high"),
        )
    )
    summary = staged(per_home, "home-summary", True)
    token_homes = (
        alive.select("doc_id", "token").join(placed.select("doc_id", "home", "part"), "doc_id")
        .select("token", "home", "part").distinct().join(summary, ["home", "part"])
    )
    token_homes = staged(token_homes, "token-homes", True)
    guest = token_homes.select(*[F.col(c).alias(f"g_{c}") for c in token_homes.columns])
    rank, guest_rank = F.struct("crowd", "home", "part"), F.struct("g_crowd", "g_home", "g_part")
    one = (F.col("c_low") == F.col("c_high")) & (F.col("g_c_low") == F.col("g_c_high")) & (F.col("c_low") == F.col("g_c_low"))
    visits = (
        token_homes.join(guest, (F.col("token") == F.col("g_token")) & (guest_rank < rank) & ~one)
        .groupBy("g_home", "g_part", "home", "part")
        .agg(F.count("*").alias("shared"), F.min(F.least("needed", "g_needed")).alias("needed"))
        .filter("shared >= needed")
        .select("g_home", "g_part", F.col("home").alias("to_home"), F.col("part").alias("to_part"))
    )
    visitors = staged(
        placed.join(visits, (F.col("home") == F.col("g_home")) & (F.col("part") == F.col("g_part"))).select(
            "doc_id", "component", "to_home", "to_part"
        ),
        "visitors",
        True,
    )
    party = visitors.groupBy("to_home", "to_part").agg(F.ceil(F.count("*") / home_size).cast("int").alias("rounds"))
    guests = visitors.join(party, ["to_home", "to_part"]).select(
        "doc_id", "component", "to_home", "to_part", F.pmod(F.xxhash64("doc_id"), F.col("rounds")).cast("int").alias("round"), F.lit(True).alias("guest")
    )
    hosts = placed.join(party, (F.col("home") == F.col("to_home")) & (F.col("part") == F.col("to_part"))).select(
        "doc_id", "component", "to_home", "to_part", F.explode(F.sequence(F.lit(0), F.col("rounds") - 1)).alias("round"), F.lit(False).alias("guest")
    )

    def across(group: pa.Table) -> pa.Table:
        is_guest = group["guest"].to_numpy()
        sets, ids, labels = _decode(group["tokens"]), group["doc_id"].to_numpy(), group["component"].to_numpy()
        pick = lambda mask: [s for s, m in zip(sets, mask, strict=True) if m]
        found = links_between(
            ids[~is_guest], pick(~is_guest), labels[~is_guest], ids[is_guest], pick(is_guest), labels[is_guest], percent
        )
        return _as_links(found)

    company = staged(guests.unionByName(hosts), "company", True)
    meeting = sets.join(broadcast_if_small(company, MAX_BROADCAST_IDS), "doc_id")
    more = meeting.groupBy("to_home", "to_part", "round").applyInArrow(across, _LINKS)
    # the classes of one id belong together
    least = digest_of.groupBy(F.col("doc_id").alias("id")).agg(F.min("rep").alias("least"), F.max("rep").alias("most"))
    same_id = (
        digest_of.join(least.filter("least < most"), F.col("doc_id") == F.col("id"))
        .filter("rep > least")
        .select(F.col("rep").alias("a"), F.col("least").alias("b"))
    )
    return digest_of, staged(links.unionByName(more).unionByName(same_id), "links", True)


def near_duplicate_components(
    docs: DataFrame, words_per_shingle: int = 3, percent: int = 90, home_size: int = 256
) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of `docs`."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    dealt = staged(deal_cells(docs, words_per_shingle, percent, _parts(docs)), "cells", True)
    sharing = staged(sharing_ids(dealt), "sharing", True)
    digests = staged(dealt.filter(F.col("part") == _DIGEST).select("doc_id", "n", "s1", "s2"), "digests")
    forget(dealt)
    named, links = link_sets(docs, digests, sharing, words_per_shingle, percent, home_size)
    component = connected_components(links)
    of_id = (
        named.join(component, F.col("rep") == F.col("node"), "left")
        .select(F.col("doc_id").alias("id"), F.coalesce("component", "rep").alias("component"))
        .distinct()
    )
    return digests.join(of_id, F.col("doc_id") == F.col("id"), "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id")
    )
