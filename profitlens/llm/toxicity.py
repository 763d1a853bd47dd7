"""Toxicity: a lexicon trie intersected with Levenshtein automata, scored in the context of each hit."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from profitlens.llm._common import small_batches

MAX_TOXIC, MAX_CLEAN = 4000, 8000  # labelled rows that the lexicon and the weights are learned from, at most
MAX_TERMS = 2000                   # words of the lexicon, and stems, at most
MIN_DOCS = 4                       # toxic documents a term needs
MIN_WEIGHT, MIN_Z = 2.0, 3.0       # smoothed log odds of a term, and its distance from 0 in standard errors
STEMS = (4, 5, 6, 7)               # lengths of word beginnings that are terms of their own (written with a *)
WINDOW = 8                         # words on either side of a hit that are its context
CACHE = 200_000                    # words and automaton steps that a task remembers
SEED = 5

# Marks of quotation and verbs of reporting, which tell a cited word from an abusive one.
QUOTES = "\"“”„«»‘’‹›"
REPORTING = ("said says saying called calls quoted quote quotes wrote writes word words term phrase "
             "sagte sagt schrieb nannte zitat wort dit disait mot citation appelé "
             "dijo dice escribió palabra cita llamó").split()

FEATURES = ("strength", "strongest", "density", "quoted", "fuzzy", "crowd")


def edits_allowed(term: str) -> int:
    """Edits by which a text's word may differ from a term: none for short ones and stems, one or two for long ones."""
    if term.endswith("*"):
        return 0
    return 0 if len(term) < 5 else 1 if len(term) < 9 else 2


class LexiconAutomaton:
    """The trie of the terms intersected with a Levenshtein automaton for each: reading a word letter by letter, a state
    is the set of trie nodes that can be reached, each with the fewest edits. States are made as words need them and
    kept (at most CACHE steps, then forgotten), so most words cost a few dictionary look-ups until no node is left.
    A term that ends with ``*`` accepts every word that begins with it."""

    def __init__(self, terms: dict[str, float]):
        self.children: list[dict[str, int]] = [{}]
        self.ends: list[str | None] = [None]
        self.most = [0]     # edits allowed by any term below the node
        self.reach = [-1]   # whether a stem ends here
        for term in sorted(terms):
            node, k = 0, edits_allowed(term)
            self.most[0] = max(self.most[0], k)
            for c in term.rstrip("*"):
                if c not in self.children[node]:
                    self.children[node][c] = len(self.children)
                    self.children.append({})
                    self.ends.append(None)
                    self.most.append(0)
                    self.reach.append(-1)
                node = self.children[node][c]
                self.most[node] = max(self.most[node], k)
            if term.endswith("*"):
                self.reach[node] = k
                self.stem = term
                self.children[node].setdefault("*", node)
            else:
                self.ends[node] = term
        self.names = {self.walk(t): t for t in terms if t.endswith("*")}
        self.clear()

    def walk(self, term: str) -> int:
        node = 0
        for c in term.rstrip("*"):
            node = self.children[node][c]
        return node

    def clear(self):
        self.steps: dict[tuple, tuple] = {}
        self.start = self.close({0: 0})

    def close(self, nodes: dict[int, int]) -> tuple:
        """Add the nodes reached by leaving out letters of a term; drop what has too many edits."""
        work = list(nodes.items())
        while work:
            node, e = work.pop()
            for c, child in self.children[node].items():
                if c != "*" and e + 1 <= self.most[child] and e + 1 < nodes.get(child, 99):
                    nodes[child] = e + 1
                    work.append((child, e + 1))
        return tuple(sorted((n, e) for n, e in nodes.items() if e <= self.most[n]))

    def step(self, state: tuple, c: str) -> tuple:
        found = self.steps.get((state, c))
        if found is None:
            nodes: dict[int, int] = {}
            for node, e in state:
                for letter, child in self.children[node].items():
                    cost = e if letter == c else e + 1
                    if letter != "*" and cost <= self.most[child] and cost < nodes.get(child, 99):
                        nodes[child] = cost
                if e + 1 <= self.most[node] and e + 1 < nodes.get(node, 99):
                    nodes[node] = e + 1
            found = self.close(nodes)
            if len(self.steps) > CACHE:
                self.steps.clear()
            self.steps[state, c] = found
        return found

    def match(self, word: str) -> tuple[str, int] | None:
        """The term nearest to the word (fewest edits, then the first by name) and the edits; None if none is near."""
        state, best = self.start, None
        for c in word:
            state = self.step(state, c)
            if not state:
                break
            for node, e in state:
                if 0 <= self.reach[node] and e <= self.reach[node] and (best is None or (e, self.names[node]) < best):
                    best = e, self.names[node]
        else:
            for node, e in state:
                term = self.ends[node]
                if term and e <= edits_allowed(term) and (best is None or (e, term) < best):
                    best = e, term
        return (best[1], best[0]) if best else None


class Scorer:
    """Features of a whole text from its hits."""

    def __init__(self, terms: dict[str, float]):
        import re

        self.terms, self.automaton = terms, LexiconAutomaton(terms)
        self.token = re.compile(rf"[^\W_]+|[{QUOTES}]")
        self.reporting, self.known = set(REPORTING), {}

    def hit(self, word: str):
        if word not in self.known:
            if len(self.known) > CACHE:
                self.known.clear()
            self.known[word] = self.automaton.match(word)
        return self.known[word]

    def features(self, text: str | None) -> list[float]:
        """strength: the hits' weights added up (a hit between quotation marks or near a verb of reporting counts a
        quarter, one edit halves it), the strongest hit, hits for a hundred words, quoted hits, misspelled ones, and hits
        with another one in their window. All zero without a hit; sums enter as logarithms."""
        from math import log1p

        tokens = self.token.findall(text.lower()) if text else []
        found = {w: h for w in set(tokens) if (h := self.hit(w))}
        if not found:
            return [0.0] * len(FEATURES)
        at = [i for i, w in enumerate(tokens) if w in found]
        strength = strongest = quoted = fuzzy = crowd = 0.0
        for j, i in enumerate(at):
            term, edits = found[tokens[i]]
            left, right = tokens[max(0, i - WINDOW):i], tokens[i + 1:i + 1 + WINDOW]
            marked = any(w in QUOTES for w in left) and any(w in QUOTES for w in right)
            cited = marked or any(w in self.reporting for w in left)
            near = (j > 0 and i - at[j - 1] <= WINDOW) or (j + 1 < len(at) and at[j + 1] - i <= WINDOW)
            score = self.terms[term] / (1 << edits) * (0.25 if cited else 1.0)
            strength += score
            strongest = max(strongest, score)
            quoted += cited
            fuzzy += edits > 0
            crowd += near
        return [log1p(strength), strongest, log1p(100.0 * len(at) / len(tokens)), log1p(quoted), log1p(fuzzy),
                log1p(crowd)]


def labelled_sample(documents: DataFrame, labels: DataFrame, training) -> DataFrame:
    """doc_id, text, toxic of at most MAX_TOXIC and MAX_CLEAN labelled documents (those with the smallest hash of the id
    among the ids that ``training`` accepts). Only ids and labels are ordered; the bounded list goes to the texts. Of the rows of one
    id the text with the smallest digest is taken, so the sample has at most as many rows as labels."""
    place = F.xxhash64(F.col("doc_id").cast("string"), F.lit(SEED))
    known = labels.where(F.col("toxic").isin(0, 1) & training(F.col("doc_id"))).select("doc_id", "toxic")
    some = known.where("toxic = 1").orderBy(place).limit(MAX_TOXIC).unionByName(
        known.where("toxic = 0").orderBy(place).limit(MAX_CLEAN))
    found = documents.select("doc_id", F.col("text").cast("string").alias("text")).join(F.broadcast(some.dropDuplicates()), "doc_id")
    # a row for each id and label, however often the id repeats: the text with the smallest digest
    return found.groupBy("doc_id", "toxic").agg(F.min_by("text", F.sha2("text", 256)).alias("text"))


def learn_lexicon(sample: DataFrame) -> dict[str, float]:
    """Terms with their weights: words, and beginnings of words, that mark toxic documents.

    Documents are counted for each word and each beginning (tasks add up what they read, a group-by the rest); a term
    needs MIN_DOCS toxic documents, smoothed log odds of MIN_WEIGHT and a significance of MIN_Z; the MAX_TERMS strongest
    words and the MAX_TERMS strongest beginnings stay. A stem that begins with another of about its strength adds nothing
    and is left out; a whole word always stays, as only words have edits and so find misspelled ones."""
    small_batches(sample.sparkSession)

    def run(batches):
        import re

        token, counts = re.compile(r"[^\W_]+"), {}

        def flush():
            terms = list(counts)
            return pa.RecordBatch.from_arrays(
                [pa.array(terms, pa.string()), pa.array([counts[t][1] for t in terms], pa.int64()),
                 pa.array([counts[t][0] for t in terms], pa.int64())], ["term", "toxic", "clean"])

        for batch in batches:
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = {w for w in token.findall(text.lower()) if len(w) > 2 and not w.isdigit()} if text else ()
                for t in {*words, *(f"{w[:n]}*" for w in words for n in STEMS if len(w) > n)}:
                    counts.setdefault(t, [0, 0])[toxic] += 1
            if len(counts) > CACHE:
                yield flush()
                counts.clear()
        if counts:
            yield flush()

    sizes = {r.toxic: r["count"] for r in sample.groupBy("toxic").count().collect()}
    toxic, clean = sizes.get(1, 0), sizes.get(0, 0)
    if not toxic:
        return {}
    terms = (sample.select("text", "toxic").mapInArrow(run, "term string, toxic long, clean long")
             .groupBy("term").agg(F.sum("toxic").alias("t"), F.sum("clean").alias("c"))
             .where(F.col("t") >= MIN_DOCS)
             .withColumn("weight", F.log((F.col("t") + 0.5) / (toxic + 1.0)) - F.log((F.col("c") + 0.5) / (clean + 1.0)))
             .withColumn("z", F.col("weight") / F.sqrt(1 / (F.col("t") + 0.5) + 1 / (F.col("c") + 0.5)))
             .where((F.col("weight") >= MIN_WEIGHT) & (F.col("z") >= MIN_Z)))
    strongest = lambda kind: terms.where(kind).orderBy(F.desc("z"), "term").limit(MAX_TERMS)
    stem = F.col("term").endswith("*")
    weights = {r.term: float(r.weight) for r in strongest(~stem).unionByName(strongest(stem)).collect()}
    kept = {}
    for t in sorted(weights, key=lambda t: (len(t.rstrip("*")), t)):
        stems = [f"{t[:n]}*" for n in STEMS if n < len(t.rstrip("*"))]
        if not t.endswith("*") or not any(s in kept and kept[s] >= weights[t] - 1.5 for s in stems):
            kept[t] = weights[t]
    return kept


def text_features(df: DataFrame, cols: list, text_col: str, terms: dict[str, float]) -> DataFrame:
    """The columns with ``x``, the array of FEATURES of each whole text."""
    spark = df.sparkSession
    small_batches(spark)
    schema = df.select(*cols).schema.add("x", T.ArrayType(T.DoubleType()))
    lexicon = spark.sparkContext.broadcast(terms)

    def run(batches):
        scorer = Scorer(lexicon.value)
        for batch in batches:
            x = [scorer.features(t) for t in batch.column(batch.num_columns - 1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(x, pa.list_(pa.float64()))], schema.names)

    return df.select(*cols, F.col(text_col).cast("string").alias("__text")).mapInArrow(run, schema)


def fit_weights(rows: list, rounds: int = 400) -> list[float]:
    """Logistic regression of the label on the features (bias first): gradient descent on the bounded sample, a small
    quadratic penalty."""
    import numpy as np

    if not rows:
        return [0.0] * (1 + len(FEATURES))
    x = np.array([[1.0, *r.x] for r in rows])
    y = np.array([r.toxic for r in rows], float)
    scale = np.maximum(np.abs(x).max(0), 1e-9)
    z, w = x / scale, np.zeros(x.shape[1])
    for _ in range(rounds):  # Newton steps are few; the penalty keeps separable samples finite
        p = 1 / (1 + np.exp(-z @ w))
        step = np.linalg.solve((z.T * np.maximum(p * (1 - p), 1e-9)) @ z + 0.01 * np.eye(len(w)),
                               z.T @ (p - y) + 0.01 * w)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return [float(v) for v in w / scale]


def learn_toxicity(documents: DataFrame, labels: DataFrame, training) -> tuple[dict[str, float], list[float]]:
    """(lexicon, weights) from the labelled documents whose ids ``training`` accepts; see labelled_sample."""
    sample = labelled_sample(documents, labels, training)
    terms = learn_lexicon(sample)
    rows = text_features(sample, ["toxic"], "text", terms).collect()  # a few numbers for each row of the sample
    return terms, fit_weights(rows)


def score_toxicity(documents: DataFrame, id_cols: list, text_col: str, model: tuple) -> DataFrame:
    """id columns and score (0 to 1) of each whole text: the logistic function of its weighted features.

    Null or empty texts, and those without a hit, get the score of the bias alone; nothing learned: 0.5. Repeated rows
    repeat; an empty table gives no rows; only the named columns are read."""
    terms, weights = model
    x = text_features(documents, id_cols, text_col, terms)
    total = F.lit(weights[0])
    for i, w in enumerate(weights[1:]):
        total = total + F.lit(w) * F.col("x")[i]
    return x.withColumn("score", 1.0 / (1.0 + F.exp(-total))).drop("x")
