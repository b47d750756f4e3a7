"""N-gram Jaccard join by universe partition: sets that are alike agree in a segment of the hashed universe."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import free_name, stored
from .components import components
from .hashing import FACTORS, U, chunks, mix, pair_chunks, shingle_sets

#: Groups of at most this many members are held together as one row; larger ones are split up.
LIGHT = 32
#: Members of a larger group that are compared with all its others in the first round, and how their number grows by round.
LEADERS, GROWTH = 8, 16
#: Comparisons with one leader that one task is given.
PER_LEADER = 256
#: Independent partitions of the universe that a set goes through until its segments suffice.
FAMILIES = 4
#: 64-bit words of the folded sketch that pairs are held against while they are made; no sketch is shorter. Too few, and
#: near copies that don't link pass by the square of their number, once for each group they share.
COARSE = 16
#: Entries (hash and row number) of one bucket, as the buckets' number is chosen from the input's size.
BUCKET_TEXT_BYTES = 8 << 20
#: Bytes of text whose index entries a task holds at once.
INDEX_BYTES = 4 << 20
#: 64-bit words of the bit table that tells, before any text moves, which ones a round asks for; at most so many rows are broadcast.
MARKED = 1 << 17


@dataclass(frozen=True)
class Plan:
    """How sets of one size band are cut: ``segments`` in all, the first ``loose`` of which also have
    their one-deletion neighbourhood indexed and so may differ by one."""

    segments: int
    loose: int


def largest_difference(n, percent: int):
    """Of a set of size n and any set at least ``percent`` similar: the most elements that are in one only.

    With sizes n and s, Jaccard t means a symmetric difference of at most (n + s)(1 - t)/(1 + t), s at most n/t.
    """
    s = n * 100 // percent
    return (n + s) * (100 - percent) // (100 + percent)


@lru_cache(maxsize=None)
def equal_only(percent: int) -> int:
    """The largest size whose sets link with equal sets alone."""
    n = 0
    while largest_difference(n + 1, percent) == 0:
        n += 1
    return n


@lru_cache(maxsize=None)
def plan_for(top: int, percent: int) -> Plan:
    """The cheapest cut for sets of up to ``top`` elements.

    A pair differs in at most H elements. A strict segment that isn't empty counts one unit, a loose one of two
    or more elements two: H + 1 units can't all be spoilt. Cost: expected index entries, and four for
    each expected segment of one element, which is what unlike texts have in common. Only cuts
    whose expected units exceed H + 1 by 1.5 deviations are considered; a set that falls short
    all the same goes on to the next family.
    """
    need = largest_difference(top, percent) + 1
    if need == 1:
        return Plan(1, 0)
    best: tuple[float, Plan] | None = None
    for loose in sorted({0, 1, 2, 3, *range(4, need, max(1, need // 12))}):
        for strict in range(max(0, need - 2 * loose), 2 * need + 8):
            m = loose + strict
            if not m:
                continue
            mean = top / m
            empty, single = np.exp(-mean), mean * np.exp(-mean)
            units = strict * (1 - empty) + loose * (2 * (1 - empty - single) + single)
            spread = (m * empty * (1 - empty) + loose * single) ** 0.5
            if units - 1.5 * spread < need + (0.02 * need if need > 8 else 0):
                continue
            cost = m * (1 - empty) + loose * mean + 4 * m * single
            if best is None or cost < best[0]:
                best = cost, Plan(m, loose)
            break  # more strict segments only cost more
    return best[1] if best else Plan(1, 1)


def bands(n: np.ndarray, percent: int) -> list[tuple[int, np.ndarray]]:
    """(largest size of a band, the sets that are in it or may have a partner in it).

    The first band holds the sets that link with equal ones alone: one signature of the whole set is all they need."""
    first = equal_only(percent) if percent < 100 else 1 << 62
    found, low = [], 1
    while low <= (int(n.max()) * 100 // percent if len(n) else 0):
        high = max(first, 1) if low == 1 else 2 * low - 1
        inside = np.flatnonzero((n <= high) & (n * 100 // percent >= low) & (n > 0))
        if len(inside):
            found.append((high, inside))
        low = high + 1
    return found


def _salt(segment: np.ndarray, high: int, family: int) -> np.ndarray:
    which = np.full(len(segment), high * FAMILIES + family, dtype=np.uint64)
    return mix(segment.astype(np.uint64) * FACTORS[20] + which * FACTORS[21])


def entries(sets: np.ndarray, at: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Index entries of many sets: (63-bit signature, set), then per set its units to spare and its largest weight.

    The lowest bit of a signature says that an element was taken off. Segments that differ by one element agree as the
    smaller one's whole and the larger one's neighbour, so two neighbours of one signature are no reason to compare.

    Sets are hash-sorted, so a segment, a range of hashes, is a run. Its signature is the sum of
    its mixed elements; taking one element off is a subtraction. Empty segments have no entry. To
    spare is what is left of the units beyond H + 1, the least over the bands of a set.
    """
    n = np.diff(at)
    spare = np.full(len(n), 1 << 30, dtype=np.int64)
    weight = np.ones(len(n), dtype=np.int64)
    sigs, owners = [], []
    for high, inside in bands(n, percent):
        plan = plan_for(high, percent)
        weight[inside] = np.maximum(weight[inside], 2 if plan.loose else 1)
        left = inside
        for family in range(FAMILIES):
            sizes = n[left]
            where = np.repeat(np.arange(len(left)), sizes)
            elements = sets[np.repeat(at[left] - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))]
            h = mix(elements + FACTORS[8 + family])
            if family:  # another order of the universe
                order = np.lexsort((h, where))
                where, h = where[order], h[order]
                position = h >> U(32)
            else:
                position = elements >> U(16)
            segment = ((position * U(plan.segments)) >> U(32)).astype(np.int64)
            run = where * plan.segments + segment
            begins = np.flatnonzero(np.diff(run, prepend=-1))
            count = np.diff(np.append(begins, len(run)))
            salt = _salt(segment[begins], high, family)
            total = np.add.reduceat(h, begins) if len(begins) else np.zeros(0, np.uint64)
            loose = segment[begins] < plan.loose
            units = np.bincount(where[begins], weights=1 + (loose & (count > 1)), minlength=len(left)).astype(np.int64)
            sigs.append(mix(total ^ salt) & ~U(1))
            owners.append(left[where[begins]])
            if plan.loose:
                cut = np.repeat(loose & (count > 1), count)
                sigs.append(mix((np.repeat(total, count)[cut] - h[cut]) ^ np.repeat(salt, count)[cut]) | U(1))
                owners.append(left[where[cut]])
            extra = units - largest_difference(sizes, percent) - 1
            done = (extra >= 0) | (family == FAMILIES - 1)
            # a set that falls short everywhere has its empty segments indexed too
            if family == FAMILIES - 1 and (extra < 0).any():
                short = np.flatnonzero(extra < 0)
                there = np.zeros((len(short), plan.segments), dtype=bool)
                place = np.full(len(left), -1)
                place[short] = np.arange(len(short))
                mine = place[where[begins]] >= 0
                there[place[where[begins]][mine], segment[begins][mine]] = True
                r, s = np.nonzero(~there)
                sigs.append(mix(_salt(s, high, family)) & ~U(1))
                owners.append(left[short[r]])
            spare[left] = np.minimum(spare[left], extra)  # below 0 as soon as one family falls short
            left = left[~done]
            if not len(left):
                break
    if not sigs:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), spare, weight
    return np.concatenate(sigs), np.concatenate(owners), spare, weight


def sketches(sets: np.ndarray, at: np.ndarray) -> list[np.ndarray]:
    """Per set the parities of how many elements fall to each of n (up to a power of two, 64 ``COARSE`` at least) places, as 64-bit words.

    Two sets differ in at least as many elements as their sketches (of one length) differ in bits. A longer
    sketch is folded to half its length by xor of its halves.
    """
    n = np.diff(at)
    bits = np.maximum(64 * COARSE, 1 << np.ceil(np.log2(np.maximum(n, 1))).astype(np.int64))
    begins = np.concatenate([[0], np.cumsum(bits // 64)])
    owner = np.repeat(np.arange(len(n)), n)
    place = (mix(sets + FACTORS[44]) & (bits[owner] - 1).astype(np.uint64)).astype(np.int64)
    words = np.zeros(int(begins[-1]), dtype=np.uint64)
    np.bitwise_xor.at(words, begins[owner] + (place >> 6), U(1) << (place & 63).astype(np.uint64))
    return np.split(words.astype(np.int64), begins[1:-1])


def may_link(percent: int, na: Column, nb: Column, sa: Column, sb: Column) -> Column:
    """False only for pairs whose sizes or sketches show a similarity below ``percent``."""
    k = F.least(F.size(sa), F.size(sb))

    def fold(s: Column) -> Column:
        halves = F.zip_with(F.slice(s, F.lit(1), k), F.slice(s, k + 1, k), lambda x, y: x.bitwiseXOR(y))
        return F.when(F.size(s) > k, halves).otherwise(s)

    apart = F.aggregate(F.zip_with(fold(sa), fold(sb), lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda t, x: t + x)
    near = apart * (100 + percent) <= (na + nb) * (100 - percent)
    # sketches further apart than one fold only occur below 50 percent and are let through
    return (F.least(na, nb) * 100 >= F.greatest(na, nb) * percent) & (
        near | (F.greatest(F.size(sa), F.size(sb)) > 2 * k))


def folded(sketch: Column) -> list[Column]:
    """The sketch folded to ``COARSE`` words, each a column of its own."""
    def word(j: int) -> Column:
        mine = F.filter(sketch, lambda _, i: F.pmod(i, F.lit(COARSE)) == j)
        return F.aggregate(mine, F.lit(0).cast("long"), lambda t, x: t.bitwiseXOR(x))

    return [word(j).alias(f"s{j}") for j in range(COARSE)]


def may_link_coarse(percent: int, left: str, right: str) -> Column:
    """As :func:`may_link`, on the folded sketches of two sides of a join, in generated code."""
    def at(side: str, name: str) -> Column:
        return F.col(f"{side}.{name}")

    na, nb = at(left, "n"), at(right, "n")
    apart = sum((F.bit_count(at(left, f"s{j}").bitwiseXOR(at(right, f"s{j}"))) for j in range(COARSE)), F.lit(0))
    return (F.least(na, nb) * 100 >= F.greatest(na, nb) * percent) & (apart * (100 + percent) <= (na + nb) * (100 - percent))


def _sizes(percent: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for first, texts in chunks([(t or "").encode("utf-8", "replace") for t in batch["text"]]):
                sets, at = shingle_sets(texts)
                rows = slice(first, first + len(texts))
                spare, weight = entries(sets, at, percent)[2:]
                n = np.diff(at)
                key = np.zeros((2, len(n)), dtype=np.uint64)
                full = np.flatnonzero(n)
                if len(full):
                    for k in (0, 1):  # an order-free 128-bit key of the set
                        key[k, full] = np.add.reduceat(mix(sets + FACTORS[40 + k]), at[full])
                yield pd.DataFrame({
                    "uid": batch["uid"].to_numpy()[rows], "id": batch["id"][rows], "mark": batch["mark"].to_numpy()[rows],
                    "n": n, "spare": spare, "weight": weight, "h1": key[0].astype(np.int64), "h2": key[1].astype(np.int64),
                    "sketch": sketches(sets, at),
                })

    return run


def _packed(texts: list[bytes], uid: np.ndarray, percent: int, buckets: int) -> pd.DataFrame:
    """Index entries of some texts, one row per bucket."""
    found, owner = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for first, part in chunks(texts):
        sig, own = entries(*shingle_sets(part), percent)[:2]
        found.append(sig)
        owner.append(own + first)
    sig, own = np.concatenate(found), np.concatenate(owner)
    bucket = ((sig >> U(32)) % U(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    ends = np.searchsorted(bucket[order], np.arange(buckets + 1))
    rows = []
    base = int(uid.min()) if len(uid) else 0
    wide = len(uid) > 0 and int(uid.max()) - base >= 1 << 16
    small = (uid - base).astype(np.uint32 if wide else np.uint16)
    for b in np.flatnonzero(np.diff(ends)):
        at = order[ends[b]:ends[b + 1]]
        rows.append((int(b), base, wide, sig[at].astype(np.uint32).tobytes(), small[own[at]].tobytes()))
    return pd.DataFrame(rows, columns=["bucket", "base", "wide", "sigs", "owners"])


def _index(percent: int, buckets: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = [(t or "").encode("utf-8", "replace") for t in batch["text"]]
            uid = batch["uid"].to_numpy()
            seen: dict[bytes, int] = {}  # equal texts of a batch are indexed once
            keep = [i for i, t in enumerate(texts) if seen.setdefault(t, i) == i]
            texts, uid = [texts[i] for i in keep], uid[keep]
            for begin, run in chunks(texts, INDEX_BYTES):
                yield _packed(run, uid[begin:begin + len(run)], percent, buckets)

    return run


def _groups(frame: pd.DataFrame) -> pd.DataFrame:
    """Rows of one bucket that share a signature: one row per different light group, one per member of a heavy one.

    A group of nothing but one-deletion neighbours is no group."""
    sig = np.concatenate([np.frombuffer(s, np.uint32) for s in frame["sigs"]])
    uid = np.concatenate([np.frombuffer(o, np.uint32 if w else np.uint16).astype(np.int64) + b
                          for o, w, b in zip(frame["owners"], frame["wide"], frame["base"], strict=True)])
    shorter, sig = (sig & 1).astype(bool), sig >> 1
    order = np.lexsort((shorter, uid, sig))  # a set that is in a group both ways is there as a whole
    sig, uid, shorter = sig[order], uid[order], shorter[order]
    new = np.concatenate([[True], (sig[1:] != sig[:-1]) | (uid[1:] != uid[:-1])])
    sig, uid, shorter = sig[new], uid[new], shorter[new]
    begins = np.flatnonzero(np.concatenate([[True], sig[1:] != sig[:-1]]))
    size = np.diff(np.append(begins, len(sig)))
    needed = ~np.logical_and.reduceat(shorter, begins)
    gids, lists = [], []
    for k in np.unique(size[(size > 1) & (size <= LIGHT) & needed]):
        members = uid[begins[(size == k) & needed][:, None] + np.arange(k)]
        gid = mix(mix(members.astype(np.uint64)).sum(axis=1, dtype=np.uint64) + U(k))
        first = np.unique(gid, return_index=True)[1]
        gids.append(gid[first].astype(np.int64))
        lists.extend(members[first].tolist())
    light = pd.DataFrame({"gid": np.concatenate(gids) if gids else np.zeros(0, np.int64)})
    light["uid"], light["whole"], light["members"] = -1, True, pd.Series(lists, dtype=object)
    heavy = np.flatnonzero(np.repeat((size > LIGHT) & needed, size))
    gid = mix((U(int(frame["bucket"].iloc[0])) << U(32)) + sig[heavy].astype(np.uint64) + FACTORS[50])
    dense = pd.DataFrame({"gid": gid.astype(np.int64), "uid": uid[heavy], "whole": ~shorter[heavy], "members": pd.Series([None] * len(heavy), dtype=object)})
    return pd.concat([light, dense]) if len(heavy) else light


def asked_for(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """Of ``rows`` (uid, mark, text) those whose ``uid`` and ``mark`` are ``rep`` and ``mark`` in ``wanted``, as (rep, text).

    A table of at most ``MARKED`` rows of 64 bits, one bit for the hash of each wanted row, goes to all tasks and rules
    out nearly all others before they are dealt by key; where it is too full to do so, they move and the join drops them.
    """
    def place(uid: str) -> Column:
        return F.pmod(F.xxhash64(uid), F.lit(64 * MARKED))

    bits = wanted.select(place("rep").alias("place")).select(
        F.shiftright("place", 6).alias("word"), F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod("place", F.lit(64)).cast("int")).alias("bit"))
    bits = bits.groupBy("word").agg(F.bit_or("bit").alias("bits"))
    likely = rows.withColumns({"word": F.shiftright(place("uid"), 6), "at": F.pmod(place("uid"), F.lit(64)).cast("int")})
    likely = likely.join(F.broadcast(bits), "word").where(F.getbit("bits", F.col("at")) == 1).select("uid", F.col("mark").alias("own"), "text")
    return likely.join(wanted, (F.col("uid") == F.col("rep")) & (F.col("own") == F.col("mark"))).select("rep", "text")


def _verify(percent: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            alike = np.zeros(len(batch), dtype=bool)
            sides = ([t.encode("utf-8", "replace") for t in batch[side]] for side in ("ta", "tb"))
            for first, pairs in pair_chunks(list(zip(*sides, strict=True))):
                sets, at = shingle_sets([t for pair in pairs for t in pair])
                for i in range(len(pairs)):
                    x, y = (sets[at[j]:at[j + 1]] for j in (2 * i, 2 * i + 1))
                    common = len(np.intersect1d(x, y, assume_unique=True))
                    alike[first + i] = 100 * common >= percent * (len(x) + len(y) - common)
            yield batch.loc[alike, ["a", "b"]]

    return run


def jaccard_components(docs: DataFrame, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``uid`` (its place), ``id``, ``n_shingles``, ``component_id`` and ``stays``
    (true for one row of each component, that of the smallest id).

    Two texts link when 100 * |intersection| >= percent * |union| of their five-word shingle sets;
    ``component_id`` is the smallest id reachable by links.

    Index: sets are cut by size band and hash range; a set's entries are hashes of its segments (and of
    their one-deletion neighbours, where the plan says so). Entries travel packed by bucket. A set whose
    segments suffice doesn't need groups that are too common: entries in groups of more than ``LIGHT`` are left out as long as the
    set has units to spare, which loses no link, as a pair is only missed if both are short
    of units, and those are kept. Nothing is capped.

    Links: copies of a set are one class first. Candidates are then compared in rounds: each class with the smallest leader of
    its groups, then what is still apart within a group: all of a light group, and of a heavy one
    ``LEADERS`` wholes, ``GROWTH`` times as many in each further round, so that rounds grow with the logarithm of a group. Heavy groups
    of one smallest member are one group: near copies share many groups, and each would make their pairs again. Pairs that are already connected are never compared, so a
    group of thousands of near copies costs about one comparison for each. Sizes and parity sketches, whose distance is a lower
    bound of the sets' difference, rule out most unlike pairs first: folded ones as a pair is made, whole ones before texts move.
    Each comparison left is exact, of whole sets (hashed to 48 bits per shingle); a round moves the texts of its own pairs only.

    A text that is NULL, empty or blank has the empty set and links with nothing: its component is
    its own id. Rows of equal id and text are rows like others; a NULL id never names a
    component unless all ids of it are NULL. Empty table: empty result. ``docs`` is read twice, and once a round that compares
    texts; it should be a stored table, whose rows keep their order.
    """
    spark = docs.sparkSession
    rows = docs.select(
        F.monotonically_increasing_id().alias("uid"), F.col(id_col).alias("id"),
        F.xxhash64(F.col(id_col), F.coalesce(F.col(text_col), F.lit(""))).alias("mark"), F.col(text_col).alias("text"),
    )
    kind = docs.schema[id_col].dataType.simpleString()
    sizes = stored(rows.mapInPandas(
        _sizes(percent), f"uid long, id {kind}, mark long, n long, spare long, weight long, h1 long, h2 long, sketch array<long>"),
        "join-sizes")
    full = sizes.where("n > 0")
    classes = full.groupBy("h1", "h2").agg(F.min("uid").alias("rep"))
    reps = stored(full.join(classes, ["h1", "h2"]).select("uid", "rep", "id", "mark", "n", "spare", "weight"), "join-classes")

    volume = docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = max(4 * parts, -(-volume // BUCKET_TEXT_BYTES))
    packed = rows.select("uid", "text").mapInPandas(
        _index(percent, buckets), "bucket int, base long, wide boolean, sigs binary, owners binary")
    groups = stored(packed.groupBy("bucket").applyInPandas(_groups, "gid long, uid long, whole boolean, members array<long>"), "join-groups")

    light = groups.where("members is not null").groupBy("gid").agg(F.first("members").alias("members"))
    light = light.select("gid", F.explode("members").alias("uid"))
    heavy = groups.where("members is null").select("gid", "uid", "whole")
    crowded = heavy.groupBy("uid").agg(F.count("*").alias("lost"))
    short = crowded.join(reps, "uid").where("spare < lost * weight").select("uid")
    heavy = heavy.join(short, "uid").select("gid", "uid", "whole")
    members = light.withColumns({"light": F.lit(True), "whole": F.lit(True)}).unionByName(heavy.withColumn("light", F.lit(False)))
    members = members.join(reps.select("uid", "rep"), "uid").groupBy("gid", "rep", "light").agg(F.max("whole").alias("whole"))
    # of groups with the same members one stays; copies that share all segments make one group, not one per segment
    prints = members.groupBy("gid").agg(
        F.min("rep").alias("lo"), F.max("rep").alias("hi"), F.max("whole").alias("any"), F.count("*").alias("size"),
        F.bit_xor(F.xxhash64("rep", "whole")).alias("p"), F.bit_xor(F.xxhash64(F.lit(7), "rep", "whole")).alias("q"))
    different = prints.where("lo < hi and any").groupBy("size", "p", "q").agg(F.min("gid").alias("gid"), F.min("lo").alias("lo")).select("gid", "lo")
    # heavy groups of one smallest member become one: pairs of a group stay in a group, and are made once, not once per group
    members = members.join(different, "gid").withColumn("gid", F.when(F.col("light"), F.col("gid")).otherwise(F.xxhash64("lo")))
    members = stored(members.groupBy("gid", "rep", "light").agg(F.max("whole").alias("whole")), "join-members")

    wanted = members.select("rep").distinct()
    outlines = stored(sizes.join(wanted, sizes["uid"] == F.col("rep")).select("rep", "mark", "n", "sketch"), "join-outlines")

    coarse = stored(outlines.select("rep", "n", *folded(F.col("sketch"))), "join-coarse")
    shape = ["n", *(f"s{j}" for j in range(COARSE))]

    def outlined(pairs: DataFrame) -> DataFrame:
        """The pairs that sizes and sketches don't rule out."""
        left = outlines.select(F.col("rep").alias("a"), F.col("n").alias("na"), F.col("sketch").alias("sa"))
        right = outlines.select(F.col("rep").alias("b"), F.col("n").alias("nb"), F.col("sketch").alias("sb"))
        sized = pairs.join(left, "a").join(right, "b").where(may_link(percent, *map(F.col, ("na", "nb", "sa", "sb")))).select("a", "b")
        return stored(sized, "join-sized")

    def verified(sized: DataFrame) -> DataFrame:
        """(a, b) of the pairs that link. Of a pair, the one that is in more pairs sends its text once per ``PER_LEADER`` of them."""
        often = stored(sized.select(F.explode(F.array("a", "b")).alias("x")).groupBy("x").agg(F.count("*").alias("times")), "join-often")
        asked = often.select(F.col("x").alias("rep")).join(outlines.select("rep", "mark"), "rep")
        texts = stored(asked_for(rows, stored(asked, "join-asked")), "join-texts")
        turned = sized.join(often.select(F.col("x").alias("a"), F.col("times").alias("ta")), "a").join(
            often.select(F.col("x").alias("b"), F.col("times").alias("tb")), "b")
        swap = F.col("tb") > F.col("ta")
        turned = stored(turned.select(
            F.when(swap, F.col("b")).otherwise(F.col("a")).alias("leader"), F.when(swap, F.col("a")).otherwise(F.col("b")).alias("rep"),
            F.ceil(F.greatest("ta", "tb") / PER_LEADER).cast("int").alias("parts"),
        ).withColumn("part", F.pmod(F.xxhash64("rep"), F.col("parts")).cast("int")), "join-turned")
        leaders = turned.select(F.col("leader").alias("rep"), "parts").distinct().join(texts.select("rep", "text"), "rep")
        leaders = leaders.select(F.col("rep").alias("leader"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.col("text").alias("ta"))
        others = turned.join(texts.select("rep", F.col("text").alias("tb")), "rep")
        both = others.join(leaders, ["leader", "part"])
        return both.select(F.col("leader").alias("a"), F.col("rep").alias("b"), "ta", "tb").mapInPandas(_verify(percent), "a long, b long")

    roots = members.select(F.col("rep").alias("node")).distinct().withColumn("root", F.col("node"))
    leader = members.groupBy("gid").agg(F.min("rep").alias("leader"))
    pairs = members.join(leader, "gid").groupBy("rep").agg(F.min("leader").alias("a")).where("a < rep")
    pairs = stored(pairs.select("a", F.col("rep").alias("b")), "join-pairs")
    tested, width = pairs, LEADERS
    while True:
        likely = outlined(pairs)
        if not likely.isEmpty():  # else nothing new is connected
            links = verified(likely)
            above = links.join(roots.select(F.col("node").alias("a"), F.col("root").alias("ra")), "a").join(
                roots.select(F.col("node").alias("b"), F.col("root").alias("rb")), "b").select(F.col("ra").alias("a"), F.col("rb").alias("b"))
            joined = components(above).select(F.col("node").alias("root"), F.col("root").alias("top"))
            roots = stored(roots.join(joined, "root", "left").select("node", F.coalesce("top", "root").alias("root")), "join-roots")

        open_ = members.join(roots.withColumnRenamed("node", "rep"), "rep")
        apart = open_.groupBy("gid").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo < hi").select("gid")
        open_ = stored(open_.join(apart, "gid").join(coarse, "rep"), "join-open")
        left = open_.select("gid", F.col("rep").alias("a"), F.col("root").alias("ra"), "light", "whole", *shape)
        right = open_.select("gid", F.col("rep").alias("b"), F.col("root").alias("rb"), *shape).alias("y")
        near = may_link_coarse(percent, "x", "y") & (F.col("ra") != F.col("rb"))
        few = left.where("light").alias("x").join(right, (F.col("x.gid") == F.col("y.gid")) & (F.col("a") < F.col("b")) & near)
        share = left.where("not light").groupBy("gid", "ra").agg(F.count("*").alias("of_root"))
        # leaders: wholes from the rarest components, one of each of several hash classes, by map-side minima
        leaders = left.where("not light and whole").join(share, ["gid", "ra"]).groupBy(
            "gid", F.pmod(F.xxhash64("a"), F.lit(width)).alias("class"))
        leaders = stored(leaders.agg(F.min(F.struct("of_root", "a", "ra", *shape)).alias("l")).select(
            "gid", "l.a", "l.ra", *(f"l.{c}" for c in shape)), "join-leaders")
        many = leaders.alias("x").join(right, (F.col("x.gid") == F.col("y.gid")) & near)
        candidates = few.select("a", "b").unionByName(
            many.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))).distinct()
        pairs = stored(candidates.join(tested, ["a", "b"], "left_anti"), "join-pairs")
        tested = tested.unionByName(pairs)
        # light groups are settled by this; leaders have then met all others of their group
        spent = leaders.select("gid", F.col("a").alias("rep"))
        rest = open_.where("not light").join(spent, ["gid", "rep"], "left_anti")
        divided = rest.groupBy("gid").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.max("whole").alias("any"))
        members = stored(rest.join(divided.where("lo < hi and any").select("gid"), "gid").select("gid", "rep", "light", "whole"), "join-members")
        width *= GROWTH
        if pairs.isEmpty() and members.isEmpty():
            break

    named = reps.join(roots.withColumnRenamed("node", "rep"), "rep", "left").withColumn("root", F.coalesce("root", "rep"))
    lowest = named.groupBy("root").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "uid")).alias("low"))
    linked = named.join(lowest, "root").select(
        "uid", "id", F.col("n").alias("n_shingles"), F.col("low.id").alias("component_id"), (F.col("uid") == F.col("low.uid")).alias("stays"))
    alone = sizes.where("n = 0").select(
        "uid", "id", F.col("n").alias("n_shingles"), F.col("id").alias("component_id"), F.lit(True).alias("stays"))
    return linked.unionByName(alone)


def one_of_each_component(docs: DataFrame, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each component of :func:`jaccard_components`; texts without words all stay."""
    row = free_name(docs, "uid")
    stays = jaccard_components(docs, percent, id_col, text_col).where("stays").select(F.col("uid").alias(row))
    return docs.withColumn(row, F.monotonically_increasing_id()).join(stays, row, "left_semi").drop(row)
