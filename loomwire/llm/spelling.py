"""Spelling variants by finite-state composition: vocabulary acceptor, one-edit transducer, the acceptor again.

The minimised acceptor of the vocabulary is built as relations, without a loop: the state of a prefix p is its right
language {q : p q in V}, named by an order-free hash of that set (sums of two 64-bit hashes of each q cut into 31-bit
halves, with the set's size), so equal right languages are one state. The acceptor is then three tables:
prefixes (p, state), edges (state, char, state) and right languages (state, q), each stored once per state.

Composing acceptor, one-edit transducer and acceptor gives the paths p . edit . q with p read by both copies (one state
s), the edit (replace a by b, or delete a) and a suffix q that both copies accept from the states after the edit:

* replace: edges (s, a, s1) and (s, b, s2), a < b, q in R(s1) and R(s2);
* delete: edge (s, a, s1) and s2 = s, q in R(s1) and R(s) (insert is the same path read the other way).

Candidate state pairs come from the edges of one state (at most the square of its out-degree, which the alphabet
bounds); q is listed from the smaller right language and looked up in the other; the accepted (s, edit, q) are joined
to every prefix of s, which enumerates exactly the accepted word pairs, each once, partitioned by the initial state's
paths (the join key is the state where the copies part). Nothing compares all pairs of a group.

All these tables grow with the vocabulary, so joins merge them in the tasks; none is broadcast.

Forms follow the pairs: a word's form is its near word of largest n (ties: smallest), if that n is at least twice its
own; roots follow forms by pointer doubling (n at least doubles along a chain, so chains are short and acyclic).

Defined results: null texts have no runs; a null doc_id counts as the empty string in the hash; repeated rows count
again; an empty table gives no rows; extra columns are not read. Words are compared by code points; Spark compares
strings by UTF-8 bytes, which is the same order. Hash collisions of two right languages (probability about 2^-120 per
pair) would merge two states.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..session import in_tasks, written
from .words import ascii_lower

RUN = r"[A-Za-zÀ-ÿ]+"


def vocabulary(docs: DataFrame, text: str = "text", key: str = "doc_id", least_length: int = 5,
               least_count: int = 3, every: int = 97) -> DataFrame:
    """(word, n): distinct runs after the hashed deletion, with their number of occurrences."""
    runs = docs.select(F.col(key).cast("string").alias("k"), F.explode(F.regexp_extract_all(
        F.col(text), F.lit(RUN), 0)).alias("r")).select("k", ascii_lower(F.col("r")).alias("r"))
    h = F.crc32(F.concat(F.coalesce("k", F.lit("")), F.lit(":"), "r").cast("binary"))
    cut = (h % F.char_length("r")).cast("int")
    word = F.when(h % every == 0, F.concat(F.expr("substring(r, 1, cut)"), F.expr("substring(r, cut + 2)"))).otherwise(
        F.col("r"))
    return (runs.withColumn("cut", cut).select(word.alias("word")).groupBy("word").agg(F.count("*").alias("n"))
            .where((F.char_length("word") >= least_length) & (F.col("n") >= least_count)))


def _halves(h):
    return [F.sum(h.bitwiseAND(F.lit(0x7FFFFFFF))), F.sum(F.shiftright(h, 31).bitwiseAND(F.lit(0x7FFFFFFF))),
            F.sum(F.shiftrightunsigned(h, 62))]


def acceptor(words: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The minimised acceptor of the words: prefixes (p, state), edges (state, c, child), right languages (state, q)."""
    splits = words.select("word", F.explode(F.sequence(F.lit(0), F.char_length("word"))).alias("i")).select(
        F.expr("substring(word, 1, i)").alias("p"), F.expr("substring(word, i + 1)").alias("q"))
    one, two = F.xxhash64(F.lit("right-a"), "q"), F.xxhash64(F.lit("right-b"), "q")
    signed = splits.groupBy("p").agg(*_halves(one), *_halves(two), F.count("*"))
    state = F.xxhash64(*[F.col(c) for c in signed.columns[1:]])
    state2 = F.xxhash64(F.lit("s"), *[F.col(c) for c in signed.columns[1:]])
    prefixes = written(signed.select("p", F.struct(state.alias("a"), state2.alias("b"),
                                                   F.col(signed.columns[-1]).alias("size")).alias("state")))
    named = prefixes.alias("c").join(in_tasks(prefixes.alias("u")), F.expr(
        "substring(c.p, 1, char_length(c.p) - 1)") == F.col("u.p")).where(F.char_length("c.p") > 0)
    edges = written(named.select(F.col("u.state").alias("state"), F.expr("substring(c.p, -1, 1)").alias("c"),
                                 F.col("c.state").alias("child")).distinct())
    right = written(splits.join(in_tasks(prefixes), "p").select("state", "q").distinct())
    return prefixes, edges, right


def near_pairs(words: DataFrame) -> DataFrame:
    """(a, b): every ordered pair of words one replaced, deleted or inserted code point apart."""
    prefixes, edges, right = acceptor(words.select("word"))
    x, y = edges.alias("x"), edges.alias("y")
    replace = x.join(in_tasks(y), "state").where(F.col("x.c") < F.col("y.c")).select(
        "state", F.col("x.c").alias("a"), F.col("y.c").alias("b"), F.col("x.child").alias("s1"),
        F.col("y.child").alias("s2"))
    delete = edges.select("state", F.col("c").alias("a"), F.lit("").alias("b"), F.col("child").alias("s1"),
                          F.col("state").alias("s2"))
    candidates = replace.unionByName(delete)
    small_first = F.col("s1.size") <= F.col("s2.size")
    listed = candidates.select("*", F.when(small_first, F.col("s1")).otherwise(F.col("s2")).alias("listed"),
                               F.when(small_first, F.col("s2")).otherwise(F.col("s1")).alias("probed"))
    suffixes = listed.join(in_tasks(right.withColumnRenamed("state", "listed")), "listed")
    probes = in_tasks(right.withColumnRenamed("state", "probed"))
    accepted = suffixes.join(probes, ["probed", "q"], "left_semi").select("state", "a", "b", "q")
    paths = accepted.join(in_tasks(prefixes), "state")
    # each unordered pair once: replacements are listed with a < b; a deletion inside a run of equal letters is one
    # pair reached by several paths
    forward = paths.select(F.concat("p", "a", "q").alias("a"), F.concat("p", "b", "q").alias("b")).distinct()
    return forward.unionByName(forward.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) by pointer doubling over word -> form."""
    current = written(forms.select("word", F.coalesce("form", "word").alias("root")))
    while True:
        hop = current.alias("a").join(in_tasks(current.alias("b")), F.col("a.root") == F.col("b.word"), "left").select(
            F.col("a.word").alias("word"), F.col("a.root").alias("old"), F.coalesce("b.root", "a.root").alias("root"))
        step = written(hop)
        if not step.where(F.col("old") != F.col("root")).limit(1).count():
            return step.select("word", "root")
        current = step.select("word", "root")


def spelling_variants(docs: DataFrame, text: str = "text", key: str = "doc_id", ratio: int = 2, **rules) -> DataFrame:
    """word, form, root, n, n_near, form_n per vocabulary word. Runs Spark jobs while it is built (roots)."""
    words = written(vocabulary(docs, text, key, **rules))
    pairs = near_pairs(words)
    scored = pairs.join(in_tasks(words.withColumnRenamed("word", "b").withColumnRenamed("n", "nb")), "b").groupBy(
        F.col("a").alias("word")).agg(F.count("*").alias("n_near"),
                                      F.min(F.struct((-F.col("nb")).alias("neg"), F.col("b").alias("b"))).alias("best"))
    forms = written(words.join(in_tasks(scored), "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(-F.col("best.neg") >= ratio * F.col("n"), F.col("best.b")).alias("form"),
        F.when(-F.col("best.neg") >= ratio * F.col("n"), -F.col("best.neg")).alias("form_n")))
    return forms.join(in_tasks(_roots(forms)), "word").select(
        "word", "form", "root", F.col("n").cast("long").alias("n"), "n_near", F.col("form_n").cast("long").alias("form_n"))
