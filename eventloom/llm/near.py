"""N-gram Jaccard join by grouped prefixes."""

from __future__ import annotations

import functools
import operator
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from eventloom.llm import kernels as K
from eventloom.llm.components import components
from eventloom.llm.tables import Scratch, join_frequent
from eventloom.scratch import release


@dataclass(frozen=True)
class Jaccard:
    """Shingles of `words` words; sets link when 100 * intersection >= percent * union.

    `overlap`: prefixes are so long that linked sets share this many shingles in them (or half of what
    may differ, if that is more; or all that they must share, if that is less)."""

    words: int = 5
    percent: int = 80
    overlap: int = 48

    def least(self, n: np.ndarray) -> np.ndarray:
        """The least intersection of a set of n with one that it links with, and its least size."""
        return -(-self.percent * n // 100)

    def shared(self, n: np.ndarray) -> np.ndarray:
        """How many shingles the prefixes of a set of n must share at least with those of a set as large."""
        return np.minimum(np.maximum((n - self.least(n)) // 2 + 1, self.overlap), self.least(n))

    def prefix(self, n: np.ndarray) -> np.ndarray:
        """Prefix lengths.  If sets x, y link, they have least(x) shingles in common at least, so the
        first shared(x) of those, in any common order, lie before x's last least(x) - shared(x)."""
        return n - self.least(n) + self.shared(n)

    def link(self, common: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return 100 * common >= self.percent * (a + b - common)


class Shingles:
    """The shingles of some rows' words, lower-cased (A-Z).  A text of fewer words is one shingle, one without words none."""

    def __init__(self, texts: K.Texts, words: int):
        low = K.LOWER[texts.buf]
        starts, ends, self.first = texts.words()
        self.name, self.words = K.span_hashes(low, starts, ends), words
        _, self.word = K.classes(low, starts, ends, self.name)
        self.hash = K.combine(self.name, words)
        self.text = (low, starts, ends)

    def contents(self, i: int) -> dict[tuple[int, ...], int]:
        """The row's different shingles, as numbers of words, and where each first stands."""
        a, z = int(self.first[i]), int(self.first[i + 1])
        w, k = self.word[a:z].tolist(), min(self.words, z - a)
        found: dict[tuple[int, ...], int] = {}
        for p in range(z - a - k + 1 if k else 0):
            found.setdefault(tuple(w[p : p + k]), a + p)
        return found

    def _positions(self, i: int) -> tuple[np.ndarray, np.ndarray, bool]:
        """The row's different hashes, where the first shingle of each stands, and whether equal hashes stand for equal words."""
        a, z = int(self.first[i]), int(self.first[i + 1])
        h = self.hash[a : z - self.words + 1]
        order = np.argsort(h, kind="stable")
        new = np.ones(len(h), bool)
        new[1:] = h[order[1:]] != h[order[:-1]]
        x, y = a + order[1:][~new[1:]], a + order[:-1][~new[1:]]
        return h[order[new]], a + order[new], self._equal(x, y)

    def _equal(self, x: np.ndarray, y: np.ndarray) -> bool:
        return all((self.word[x + k] == self.word[y + k]).all() for k in range(self.words))

    def of(self, i: int) -> np.ndarray:
        """A sorted entry for each different shingle of a row.  Equal shingles have equal entries in all rows.
        Others may too; where a row itself has such, the second has a number more in its entry and so on, so
        entries are as many as shingles, and two rows share as many entries as shingles at least."""
        a, z = int(self.first[i]), int(self.first[i + 1])
        if z - a < self.words:
            return K.combine(self.name[a:z], z - a) if z > a else np.zeros(0, np.uint64)
        h = np.sort(self.hash[a : z - self.words + 1])
        again = h[1:] == h[:-1]
        if not again.any():
            return h
        found, _, exact = self._positions(i)
        if exact:
            return found
        seen: dict[int, int] = {}
        out = []
        for at in self.contents(i).values():
            h = self.hash[at]
            k = seen[int(h)] = seen.get(int(h), -1) + 1
            out.append(K.mix(np.array([h + np.uint64(k)]))[0] if k else h)
        return np.sort(np.array(out, np.uint64))

    def common(self, i: int, j: int) -> tuple[int, int, int]:
        """How many shingles both rows have, and each of them: by their words."""
        if min(self.first[i + 1] - self.first[i], self.first[j + 1] - self.first[j]) >= self.words:
            (x, at, one), (y, to, two) = self._positions(i), self._positions(j)
            _, p, q = np.intersect1d(x, y, assume_unique=True, return_indices=True)
            if one and two and self._equal(at[p], to[q]):
                return len(p), len(x), len(y)
        x, y = self.contents(i).keys(), self.contents(j).keys()
        return len(x & y), len(x), len(y)


#: Words of 64 bits of a set's parity map.
PARITY_WORDS = 16
#: Rounds of stars go on while completion has more than PAIRS pairs a row to filter and each round spares it a
#: tenth of them; STARS at most.  They only save work: completion is exact after any number of them.
PAIRS, STARS = 2, 12
#: Groups of a shingle that are paired in one task.
BLOCK = 2000
#: Slices of the shingles that are counted, and whose groups are paired, one after the other.
SLICES = 4


def parity(shingles: np.ndarray) -> np.ndarray:
    """Which of 64 * PARITY_WORDS buckets an odd number of shingles falls in.  Two maps differ in no more
    bits than their sets have elements in one of them only."""
    odd = np.bincount((K.mix(shingles) >> np.uint64(54)).astype(np.int64) % (64 * PARITY_WORDS), minlength=64 * PARITY_WORDS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _differ(x: str, y: str) -> Column:
    return functools.reduce(operator.add, [F.bit_count(F.col(x)[i].bitwiseXOR(F.col(y)[i])) for i in range(PARITY_WORDS)])


def _least(n: Column, percent: int) -> Column:
    return F.ceil(n * percent / 100)


def jaccard_components(df: DataFrame, rule: Jaccard = Jaccard(), key: str = "doc_id", text: str = "text", scratch: Scratch | None = None, digests: Callable[[np.ndarray, np.ndarray, np.ndarray], np.ndarray] = K.digests) -> DataFrame:
    """(key, n_shingles, component_id) for each row: the smallest key that links of `rule` reach.

    1. Screen: each set's prefix in hash order.  A shingle counts as shared if two different texts have
       it in their prefixes; sets with fewer shared ones than any link needs can't link and end here.
       Texts of equal words (lower-cased) go on as one.
    2. Grouped prefix join: the survivors' prefixes, ordered rarest first, shrink again; sets of equal
       prefix and size form a group.  Stars of candidates (each member to its group's first; each set to
       the likest among one random set of each of its prefix shingles, in rounds) link most of what belongs together.
    3. Completion: pairs of groups that share a prefix shingle, agree in size and don't lie in one component
       together are taken once each, at their first, then expanded to their members in different components and verified.
       Parity maps, whose differing bits bound the symmetric difference from below, filter groups (by their
       leaders' maps, less what members' maps may differ from those), members of one with the other, and members.
       The groups of a shingle's largest component aren't paired with each other; a shingle of many groups
       is paired in blocks of BLOCK groups, so no task has all its pairs.

    Hashes only propose.  Sizes and intersections are counted by words, texts of equal words are known by
    128-bit `digests`, both halves.  Shingles of very many texts are counted by partial aggregation and broadcast.  Null
    or empty texts have no shingles and link with nothing; a null key has component null and takes no
    part; rows that share a key are one document for linking, if their texts differ each may bring links;
    an empty table gives no rows, other columns play no part.
    """
    scratch = scratch or Scratch(df.sparkSession)
    written, percent = scratch.written, rule.percent

    def screen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, ids, prefixes = [], [], []
            for part in K.blocks(batch.column(1)):
                rows = Shingles(part, rule.words)
                words, begin = K.joined(*rows.text)
                ids.append(digests(words, begin[rows.first[:-1]], begin[rows.first[1:]]).view(np.int64))
                for i in range(len(part)):
                    s = rows.of(i)
                    sizes.append(len(s))
                    prefixes.append(s[: int(rule.prefix(np.int64(len(s))))].view(np.int64) if len(s) else s.view(np.int64))
            ids = np.concatenate(ids) if ids else np.zeros((0, 2), np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int32()), pa.array(ids[:, 0]), pa.array(ids[:, 1]), pa.array(prefixes, pa.list_(pa.int64()))], ["doc", "n", "set", "check", "prefix"])

    docs = df.select(F.col(key).cast("long").alias("doc"), text)
    sets = written(docs.mapInArrow(screen, "doc long, n int, set long, check long, prefix array<long>"))
    copies = written(sets.where("n > 0 and doc is not null").groupBy("set", "check").agg(F.min("doc").alias("first")))
    entries = sets.where("doc is not null").select("doc", "set", F.explode("prefix").alias("h"))
    # Texts are counted apart by half of their digest; where that half stands for several, all their shingles go on.
    alike = copies.groupBy("set").agg(F.count("*").alias("_k")).where("_k > 1").select("set", F.lit(1).alias("_alike"))
    several = F.col("x") != F.col("y")
    more = []
    if not alike.isEmpty():
        entries, several, more = entries.join(alike, "set", "left"), several | (F.col("_alike") > 0), [F.max(F.coalesce("_alike", F.lit(0))).alias("_alike")]

    def screened(k: int) -> DataFrame:
        """(doc, h, often) of one slice of the shingles, those that texts share: slices go one by one, each with its part of the rows."""
        own = entries.where(F.pmod(F.xxhash64("h"), F.lit(SLICES)) == k)
        shared = written(own.groupBy("h").agg(F.min("set").alias("x"), F.max("set").alias("y"), F.count("*").alias("often"), *more).where(several).select("h", "often", F.col("often").alias("_n")))
        out = written(join_frequent(own.select("doc", "h"), shared, ["h"], "_n"))
        scratch.drop(shared)
        release(df.sparkSession)
        return out

    parts = [screened(k) for k in range(SLICES)]
    kept = functools.reduce(DataFrame.unionByName, parts).groupBy("doc").agg(F.collect_set(F.struct("often", "h")).alias("hs"))
    smallest = _least(F.col("n"), percent)
    needed = F.least(F.greatest(F.floor((smallest - _least(smallest, percent)) / 2) + 1, F.lit(rule.overlap)), _least(smallest, percent))
    kept = kept.join(sets.select("doc", "n", "set", "check"), "doc").withColumn("needed", needed).where(F.size("hs") >= F.col("needed"))
    prefix = F.transform(F.slice(F.array_sort("hs"), 1, (F.size("hs") - F.col("needed") + 1).cast("int")), lambda x: x["h"])
    ranked = written(kept.withColumn("prefix", prefix).groupBy("set", "check", "n").agg(F.min_by(F.struct("doc", "prefix"), "doc").alias("r")).select("n", "r.*"))
    scratch.drop(*parts)
    # A group is known by its prefix, whose digest is all that its members carry; a large one meets its leader in a join.
    named = ranked.select("n", "doc", "prefix", F.md5(F.array_join(F.transform("prefix", lambda h: F.hex(h)), " ")).alias("name"))
    grouped = written(named.groupBy("n", "name").agg(F.min("doc").alias("leader"), F.min_by("prefix", "doc").alias("prefix")))
    members = named.select("n", "name", "doc").join(grouped.select("n", "name", "leader"), ["n", "name"]).select("n", "leader", "doc")
    groups = grouped.select("n", "leader", "prefix")
    texts = written(docs.join(ranked.select("doc").hint("merge"), "doc"))

    def verify(pairs: DataFrame) -> DataFrame:
        def common(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                n, ok = len(batch), []
                both = pa.concat_arrays([batch.column(2), batch.column(3)]).take(pa.array(np.arange(2 * n).reshape(2, n).T.ravel()))
                for part in K.blocks(both, group=2):
                    rows = Shingles(part, rule.words)
                    found = np.array([rows.common(i, i + 1) for i in range(0, len(part), 2)], np.int64)
                    ok.append(rule.link(*found.T))
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(np.concatenate(ok) if ok else np.zeros(0, bool)))

        x, y = texts.select(F.col("doc").alias("a"), F.col(text).alias("ta")), texts.select(F.col("doc").alias("b"), F.col(text).alias("tb"))
        return written(pairs.join(x, "a").join(y, "b").select("a", "b", "ta", "tb").mapInArrow(common, "a long, b long"))

    def maps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = []
            for part in K.blocks(batch.column(1)):
                rows = Shingles(part, rule.words)
                bits += [parity(rows.of(i)) for i in range(len(part))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(bits, pa.list_(pa.int64()))], ["doc", "bits"])

    def may_link(p: str, q: str, m: str, n: str, less: Column | int = 0) -> Column:
        """For sizes m, n and parity maps that differ in no fewer bits than p, q do, `less` so many."""
        return _sizes(m, n) & ((_differ(p, q) - less) * (100 + percent) <= (F.col(m) + F.col(n)) * (100 - percent))

    def _sizes(m: str, n: str) -> Column:
        return F.greatest(m, n) * percent <= F.least(m, n) * 100

    members = written(members.join(texts.mapInArrow(maps, "doc long, bits array<long>"), "doc"))
    leaders = members.where("doc = leader").select("leader", F.col("bits").alias("own"))
    # Maps of a group's members differ from its leader's in `radius` bits at most.
    spheres = written(members.join(leaders, "leader").groupBy("leader").agg(F.first("own").alias("own"), F.max(_differ("own", "bits")).alias("radius")))
    links = verify(members.where("doc <> leader").select(F.col("leader").alias("a"), F.col("doc").alias("b")))
    turn, before = 0, float("inf")
    while True:
        labelled = written(members.join(components(links, scratch).withColumnRenamed("id", "doc"), "doc", "left").withColumn("component", F.coalesce("component", "doc")))
        parts = labelled.groupBy("leader").agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
        rows_of_groups = written(groups.join(parts, "leader").select(F.posexplode("prefix").alias("at", "h"), "leader", "n", "lo", "hi"))
        mixed = rows_of_groups.groupBy("h", "lo").agg(F.count("*").alias("c"), F.max("hi").alias("hi")).groupBy("h").agg(F.max_by("lo", F.struct("c", "lo")).alias("main"), F.min("lo").alias("x"), F.max("hi").alias("y"), F.sum("c").alias("often"), F.max("c").alias("largest"))
        mixed = written(mixed.where("x <> y").select("h", "main", "often", "largest", F.col("often").alias("_n")))
        size = mixed.agg(F.sum("often").alias("rows"), F.sum(F.col("often").cast("double") * F.col("often") - F.col("largest") * F.col("largest")).alias("pairs")).first()
        done = turn >= STARS or (size["pairs"] or 0) <= PAIRS * (size["rows"] or 0) or (turn > 1 and size["pairs"] > 0.9 * before)
        rows = join_frequent(rows_of_groups, mixed, ["h"], "_n")
        if done:
            break
        units = rows.select("h", "main", "leader").join(labelled, "leader")
        choice = F.xxhash64("h", "doc", F.lit(turn))
        if turn:
            choice = F.struct(F.col("component") != F.col("main"), choice)
        pivots = units.groupBy("h").agg(F.min_by(F.struct("doc", "component", "n", "bits"), choice).alias("p")).select("h", F.col("p.doc").alias("a"), F.col("p.component").alias("ca"), F.col("p.n").alias("na"), F.col("p.bits").alias("ba"))
        star = units.join(pivots, "h").where((F.col("component") != F.col("ca")) & may_link("bits", "ba", "n", "na"))
        star = star.groupBy(F.col("doc").alias("b")).agg(F.min_by("a", F.struct(_differ("bits", "ba"), "a")).alias("a"))
        links = written(links.union(verify(star.select("a", "b"))))
        turn, before = turn + 1, size["pairs"]
        release(df.sparkSession)

    # Each block of a shingle's groups meets each other block in a task of its own.
    block = lambda x: F.pmod(F.xxhash64(x), F.ceil(F.col("often") / BLOCK))
    every = F.explode(F.sequence(F.lit(0), F.ceil(F.col("often") / BLOCK).cast("int") - 1)).alias("r")
    # What comes before the shingle: a pair of groups is taken at the first shingle that their prefixes share.
    wide = written(spheres.join(groups.select("leader", "prefix"), "leader"))

    def paired(k: int) -> DataFrame:
        """The pairs at one slice of the shingles: rows with maps and prefixes are wide, so slices go one by one."""
        release(df.sparkSession)
        own = rows.where(F.pmod(F.xxhash64("h"), F.lit(SLICES)) == k).join(wide, "leader").withColumn("rarer", F.slice("prefix", F.lit(1), F.col("at")))
        one = own.where("lo <> main or hi <> main").select("h", F.col("own").alias("oa"), F.col("radius").alias("ra"), F.col("rarer").alias("ea"), block("leader").alias("p"), every, F.col("leader").alias("ga"), F.col("n").alias("na"), F.col("lo").alias("loa"), F.col("hi").alias("hia"))
        two = own.select("h", F.col("own").alias("ob"), F.col("radius").alias("rb"), F.col("rarer").alias("eb"), block("leader").alias("r"), every.alias("p"), F.col("leader").alias("gb"), F.col("n").alias("nb"), F.col("lo").alias("lob"), F.col("hi").alias("hib"), ((F.col("lo") == F.col("main")) & (F.col("hi") == F.col("main"))).alias("mb"))
        apart = (F.least("loa", "lob") < F.greatest("hia", "hib")) & (F.col("mb") | (F.col("ga") <= F.col("gb")))
        close = apart & may_link("oa", "ob", "na", "nb", F.col("ra") + F.col("rb")) & ~F.arrays_overlap("ea", "eb")
        return written(one.join(two, ["h", "p", "r"]).where(close).select(F.least("ga", "gb").alias("ga"), F.greatest("ga", "gb").alias("gb")).distinct())

    slices = [paired(k) for k in range(SLICES)]
    pairs = functools.reduce(DataFrame.union, slices)
    left = labelled.select(F.col("leader").alias("ga"), F.col("doc").alias("ua"), F.col("component").alias("ca"), F.col("n").alias("na"), F.col("bits").alias("ba"))
    right = labelled.select(F.col("leader").alias("gb"), F.col("doc").alias("ub"), F.col("component").alias("cb"), F.col("n").alias("nb"), F.col("bits").alias("bb"))
    ends = labelled.groupBy("leader").agg(F.min("component").alias("lob"), F.max("component").alias("hib"), F.first("n").alias("nb"))
    ends = spheres.join(ends, "leader").select(F.col("leader").alias("gb"), F.col("own").alias("ob"), F.col("radius").alias("rb"), "lob", "hib", "nb")
    # One side's members first, those that may link with one of the other group; then the other's.
    half = pairs.join(ends, "gb").join(left, "ga").where(((F.col("ca") != F.col("lob")) | (F.col("ca") != F.col("hib"))) & may_link("ba", "ob", "na", "nb", F.col("rb")))
    across = half.select("ga", "gb", "ua", "ca", "na", "ba").join(right, "gb").where((F.col("ca") != F.col("cb")) & ((F.col("ga") != F.col("gb")) | (F.col("ua") < F.col("ub"))) & may_link("ba", "bb", "na", "nb"))
    links = written(links.union(verify(across.select(F.col("ua").alias("a"), F.col("ub").alias("b")))))

    found = components(links, scratch).withColumnRenamed("id", "first")
    of_set = written(copies.join(found, "first", "left").select("set", "check", F.coalesce("component", "first").alias("component_id")))
    scratch.drop(copies, ranked, grouped, texts, members, spheres, wide, rows_of_groups, labelled, mixed, links, *slices)
    out = sets.select("doc", "n", "set", "check").join(of_set, ["set", "check"], "left")
    out = out.select(F.col("doc").alias(key), F.col("n").cast("long").alias("n_shingles"), F.when(F.col("doc").isNotNull(), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc"))).alias("component_id"))
    out = written(out)
    scratch.drop(sets, of_set)
    return out
