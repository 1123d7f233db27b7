"""Spelling variants: words one edit apart, found by a frontier that descends a relational trie."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tallytide.llm.common import ascii_lower, written
from tallytide.operators.sizing import Settled, broadcast_join, lookup_join, settle

RUN = "[A-Za-zÀ-ÿ]+"
#: Levels of the trie that one job builds; words that share longer prefixes take further jobs.
STRATUM = 32
#: Bytes up to which a level of the trie is broadcast; the driver holds each broadcast several times.
SMALL = 4 * 1024 * 1024
#: Powers of two by which a trie without branches is skipped.
SKIPS = [1 << i for i in range(20)]


def observed_words(
    docs: DataFrame,
    least: int = 7,
    times: int = 2,
    misspelt: int | None = 31,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """(word, n): the runs of letters of all texts, A-Z in lower case, that have ``least`` code points
    or more and occur ``times`` or more.

    A run whose CRC-32 with its id (``id:run``) is divisible by ``misspelt`` loses the code point at
    that checksum modulo its length before it counts. Counts are combined inside the map tasks.
    """
    runs = F.regexp_extract_all(F.col(text), F.lit(RUN), F.lit(0))
    rows = docs.select(
        F.coalesce(F.col(doc_id).cast("string"), F.lit("")).alias("id"), F.explode(runs).alias("run")
    )
    rows = rows.filter(F.char_length("run") >= least).withColumn("run", ascii_lower(F.col("run")))
    word = F.col("run")
    if misspelt:
        rows = rows.withColumn("h", F.crc32(F.concat("id", F.lit(":"), "run")))
        shorter = F.expr("concat(left(run, at), substring(run, at + 2))")
        rows = rows.withColumn("at", (F.col("h") % F.char_length("run")).cast("int"))
        word = F.when(F.col("h") % misspelt == 0, shorter).otherwise(word)
    rows = rows.select(word.alias("word")).filter(F.char_length("word") >= least)
    return rows.groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= times)


def _edges(live: DataFrame, depth: int) -> DataFrame:
    """The edges (depth, node, ch, child, word, n) of ``STRATUM`` levels below nodes at ``depth``.

    ``live`` has (word, n, node); a node stands for a prefix that two words or more share, and its
    number follows from the letters on the way to it. A word that ends at a node is an edge without a
    letter. An edge with one word below holds that word and is where the trie ends.
    """
    level = F.sequence(F.lit(0), F.least(F.lit(STRATUM - 1), F.char_length("word") - depth))
    rows = live.select("word", "n", "node", F.explode(level).alias("at")).selectExpr(
        f"{depth} + at AS depth",
        f"if(at = 0, node, xxhash64(node, substring(word, {depth + 1}, at))) AS node",
        f"substring(word, {depth + 1} + at, 1) AS ch",
        f"if(char_length(word) = {depth} + at, xxhash64(node, word, 'end'), "
        f"xxhash64(node, substring(word, {depth + 1}, at + 1))) AS child",
        "word",
        "n",
    )
    edges = rows.groupBy("depth", "node", "ch", "child").agg(
        F.count(F.lit(1)).alias("words"), F.min("word").alias("word"), F.min("n").alias("n")
    )
    alone = F.col("words") == 1
    kid = F.struct(
        "ch", "child", "words", F.when(alone, F.col("word")).alias("word"), F.when(alone, F.col("n")).alias("n")
    )
    nodes = edges.groupBy("depth", "node").agg(
        F.sum("words").alias("below"), F.collect_list(kid).alias("kids")
    )
    shared = nodes.filter("below > 1").select("depth", "node", F.inline("kids"))
    return shared.sortWithinPartitions("depth")


class Trie:
    """The edges of a vocabulary, level by level, built ``STRATUM`` levels at a time."""

    def __init__(self, words: DataFrame):
        self.live = words.withColumn("node", F.xxhash64(F.lit("")))
        self.depth = 0
        self.edges = written(_edges(self.live, 0), "edges")
        self.levels: dict[int, Settled] = {}

    def level(self, depth: int) -> Settled:
        """The edges that start ``depth`` letters below the root."""
        if depth not in self.levels:
            if depth >= self.depth + STRATUM:
                self._descend()
            found = self.edges.filter(F.col("depth") == depth).drop("depth", "words")
            self.levels[depth] = settle(found)
        return self.levels[depth]

    def branchless(self, depth: int) -> bool:
        table = self.level(depth).table
        return table.select("node").distinct().count() == self.level(depth).rows

    def _descend(self) -> None:
        last = F.col("depth") == self.depth + STRATUM - 1
        shared = self.edges.filter(last & (F.col("words") > 1)).select(F.col("child").alias("node"))
        deeper = self.live.filter(F.char_length("word") >= self.depth + STRATUM).selectExpr(
            "word", "n", f"xxhash64(node, substring(word, {self.depth + 1}, {STRATUM})) AS node"
        )
        self.live = written(lookup_join(deeper, shared, "node", "left_semi", limit_bytes=SMALL), "live")
        self.depth += STRATUM
        self.edges = written(_edges(self.live, self.depth), "edges")

    def skip(self) -> int | None:
        """Goes to the end of the stratum and on to where words part again; the new depth, or None if
        no words share a prefix of that length. Only for a trie without branches or states there."""
        self._descend()
        ends = self.live.groupBy("node").agg(F.min("word").alias("low"), F.max("word").alias("high"))
        ends, steps = written(ends, "ends"), [0]
        while steps:
            agree = [
                F.expr(
                    f"bool_and(char_length(low) >= {self.depth + k} AND "
                    f"substring(low, {self.depth + 1}, {k}) = substring(high, {self.depth + 1}, {k}))"
                )
                for k in SKIPS
            ]
            nodes, *same = ends.agg(F.count(F.lit(1)), *agree).first()
            if not nodes:
                return None
            steps = [k for k, whole in zip(SKIPS, same, strict=True) if whole]
            self.depth += max(steps, default=0)
        self.edges = written(_edges(self.live, self.depth), "edges")
        return self.depth


def _fresh_states(level: DataFrame) -> tuple[DataFrame, DataFrame]:
    """New states with their one edit: a letter more at a node, still to be advanced, and another
    letter at a node, one level down. A node has an edge per letter at most."""
    none = "CAST(NULL AS STRING)"
    longer = level.filter("ch != ''").selectExpr(
        "node AS p", f"{none} AS p_word", "CAST(NULL AS BIGINT) AS p_n",
        "child AS q", "word AS q_word", "n AS q_n", "1 AS extra", "ch AS fresh",
    )
    letters = level.filter("ch != ''")
    left = letters.selectExpr("node", "ch", "child AS p", "word AS p_word", "n AS p_n")
    right = letters.selectExpr("node AS at", "ch AS other", "child AS q", "word AS q_word", "n AS q_n")
    pairs = left.join(right, (F.col("node") == F.col("at")) & (F.col("ch") < F.col("other")))
    return longer, pairs.selectExpr(
        "p", "p_word", "p_n", "q", "q_word", "q_n", "0 AS extra", f"{none} AS fresh"
    )


def _meet(states: DataFrame, level: Settled, on: list[str], *columns: str) -> DataFrame:
    """States with the edges of a level, whose size is known; states without an edge stay.

    A node is in as many states as there are prefixes within one edit of it, so no key is heavy.
    """
    edges = level.table.selectExpr(*columns)
    return broadcast_join(states, edges, on, "left") if level.bytes <= SMALL else states.join(edges, on, "left")


def _advance(states: DataFrame, trie: Trie, depth: int) -> DataFrame:
    """States whose word side stands at ``depth`` go one equal letter down on both sides.

    A side with one word left is read off that word. The letter after an additional one must differ
    from it, so that a longer word is reached one way only.
    """
    columns = ("ch", "word AS w2", "n AS n2")
    moved = _meet(states, trie.level(depth), ["p"], "node AS p", "child AS p2", *columns).selectExpr(
        "coalesce(p2, p) AS p",
        "coalesce(p_word, w2) AS p_word",
        "coalesce(p_n, n2) AS p_n",
        "q", "q_word", "q_n", "extra", "fresh",
        f"coalesce(ch, substring(p_word, {depth + 1}, 1)) AS ch",
    )
    moved = moved.filter("fresh IS NULL OR ch != fresh").drop("fresh")
    met = []
    for extra in (0, 1):
        part = moved.filter(F.col("extra") == extra)
        level = trie.level(depth + extra)
        part = _meet(part, level, ["q", "ch"], "node AS q", "child AS q2", *columns)
        part = part.filter(f"q2 IS NOT NULL OR substring(q_word, {depth + extra + 1}, 1) = ch")
        met.append(
            part.selectExpr(
                "p", "p_word", "p_n", "coalesce(q2, q) AS q", "coalesce(q_word, w2) AS q_word",
                "coalesce(q_n, n2) AS q_n", "extra", "CAST(NULL AS STRING) AS fresh",
            )
        )
    return met[0].unionByName(met[1])


def variant_links(words: DataFrame) -> DataFrame:
    """(word, n, near, near_n): every two words that differ by one inserted, deleted or replaced code
    point, in both directions.

    ``words`` has (word, n), a row per word. Its trie is a table of edges. A state is a prefix of a
    word and its place (a node, which all words with that prefix share), another node, and the one
    edit that lies between them. Every level adds the states whose edit falls there and joins all
    states with the edges of that level on both sides, so that only equal letters go on. Two sides
    with one word each are compared at once; they are neighbours if what is left of both is equal.

    States are as many as prefixes within one edit of each other, not as pairs of words: a node has
    one edge per letter at most. The rounds are as many as the letters that several words share from
    their start, or up to one edit; stretches in which no words part and no state is open are skipped.
    The states of a round are written to the shared folder; only counts reach the driver.
    """
    trie = Trie(words)
    links, states, alive = [], None, 0
    depth: int | None = 0
    while depth is not None and (alive or trie.level(depth).rows):
        if depth == trie.depth + STRATUM - 1 and not alive and trie.branchless(depth):
            depth = trie.skip()
            continue
        longer, pairs = _fresh_states(trie.level(depth).table)
        front = longer if states is None else longer.unionByName(states)
        moved = _advance(front, trie, depth).unionByName(pairs)
        both = "p_word IS NOT NULL AND q_word IS NOT NULL"
        rests = f"substring(p_word, {depth + 2}) = substring(q_word, {depth + 2} + extra)"
        seen = Observation()
        moved = written(
            moved.filter(f"NOT ({both}) OR {rests}").observe(
                seen, F.count_if(~F.expr(both)).alias("open")
            ),
            "states",
        )
        links.append(moved.filter(both))
        states, alive = moved.filter(f"NOT ({both})"), seen.get["open"]
        depth += 1
    pairs = reduce(DataFrame.unionByName, links) if links else None
    if pairs is None:
        return words.selectExpr("word", "n", "word AS near", "n AS near_n").limit(0)
    # numbers of nodes are hashes: what they found is compared itself
    pairs = written(pairs.filter("levenshtein(p_word, q_word, 1) = 1"), "links")
    one = pairs.selectExpr("p_word AS word", "p_n AS n", "q_word AS near", "q_n AS near_n")
    return one.unionByName(
        pairs.selectExpr("q_word AS word", "q_n AS n", "p_word AS near", "p_n AS near_n")
    )


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) of words that have a form, by following forms in doubled steps.

    A form is more frequent than its word by a factor, so chains are as short as a logarithm.
    """
    ways = written(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        step = ways.select(F.col("word").alias("root"), F.col("root").alias("next"))
        seen = Observation()
        ways = written(
            lookup_join(ways, step, "root", "left", limit_bytes=SMALL)
            .observe(seen, F.count("next").alias("moved"))
            .select("word", F.coalesce("next", "root").alias("root")),
            "roots",
        )
        if not seen.get["moved"]:
            return ways


def spelling_variants(
    docs: DataFrame,
    least: int = 7,
    times: int = 2,
    ratio: int = 10,
    misspelt: int | None = 31,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row per word of ``observed_words``: word, form, root, n, n_near, form_n.

    Words are near if one code point inserted, deleted or replaced makes one the other. A word's form
    is its most frequent near word (of several the first in code-point order) if that occurs
    ``ratio`` times as often as the word or more; its root is where following forms ends, the word
    itself without one. ``n_near`` counts the near words.

    Null and empty texts have no words. A null id counts as empty text in the checksum. Repeated rows
    count each. Words may be of any length. Texts without such words, and empty tables, give an empty
    result; columns beside id and text are not looked at.
    """
    words = written(observed_words(docs, least, times, misspelt, doc_id, text), "words")
    found = variant_links(words)
    best = found.groupBy("word").agg(
        F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near"))).alias("best"),
        F.count(F.lit(1)).alias("n_near"),
        F.min("n").alias("own"),
    )
    likely = -F.col("best.less") >= ratio * F.col("own")
    best = written(
        best.select(
            "word",
            "n_near",
            F.when(likely, F.col("best.near")).alias("form"),
            F.when(likely, -F.col("best.less")).alias("form_n"),
        ),
        "near",
    )
    roots = _roots(best.filter("form IS NOT NULL"))
    # one row per word on all sides
    named = words.join(best, "word", "left").join(roots, "word", "left")
    return named.select(
        "word",
        "form",
        F.coalesce("root", "word").alias("root"),
        "n",
        F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"),
        "form_n",
    )
