"""Problem 9: subject areas of documents by latent Dirichlet allocation.

Terms are coded by hash, so the model's size is fixed and the corpus is parsed once. A variational LDA is fitted over all documents: the E-step
runs where the documents are, topic-term sums are added up in a tree. As many topics as there are subjects start from terms of hand-labelled
documents, others start from the corpus as a whole and take up what belongs to no subject. Topics are mapped to subjects by their top
terms. A document's topic proportions are inferred, its sentences are folded in under them, and a sentence is about a subject if the
subject's topics have enough of its proportions.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuscle.llm.boundaries import scan
from corpuscle.llm.languages import LANGUAGES, language
from corpuscle.ontology import normal
from corpuscle.session import settle
from corpuscle.sources.tables import table

#: Terms of a language are coded into so many places (a power of two); places of fewer than MIN_DOCS documents say nothing.
PLACES, MIN_DOCS = 1 << 17, 3
#: Labelled documents that topics start from and that the limit for sentences is fitted on: those least by hash of their id.
LABELLED = 20_000
OTHER_TOPICS, ROUNDS = 8, 4
ALPHA, ETA = 0.1, 0.05
#: Topic proportions have settled when a step moves none of them by this much.
SETTLED = 5e-3
#: Weight of the document's proportions, in terms, when a sentence is folded in; a document is about a subject from SHARE of its sentences on.
CONTEXT, SHARE = 2.0, 0.2
#: Proportions of a sentence that are tried as its limit; without labels that tell, LIMIT. Labels of other languages count OTHERS.
LIMITS, LIMIT, OTHERS = [0.04 + 0.01 * i for i in range(40)], 0.1, 0.05
TOP_TERMS = 40
#: Places of one row of topic-term sums; from so many tasks on, sums are added in two steps.
CHUNK, WIDE = 1 << 12, 256

_RUN = re.compile(r"[\u3040-\u30ff\u4e00-\u9fff]+|[\u0e00-\u0e7f]+|[\u0900-\u097f]+|[^\W\d_]+(?:['’-][^\W\d_]+)*")


def terms(sentence: str) -> list[str]:
    """Distinct terms of a sentence: words, pairs of words; in scripts without spaces, runs of characters."""
    out: dict[str, None] = {}
    before = ""
    for run in _RUN.findall(sentence):
        c = run[0]
        if "\u3040" <= c <= "\u9fff":
            out |= dict.fromkeys(run[i : i + n] for n in (2, 3) for i in range(len(run) - n + 1))
            before = ""
        elif "\u0e00" <= c <= "\u0e7f":
            out |= dict.fromkeys(run[i : i + 5] for i in range(len(run) - 4))
            before = ""
        else:
            w = run.lower()
            if len(w) > 2:
                out[w] = None
            if before:
                out[before + " " + w] = None
            before = w
    return list(out)


def place(term: str, block: int) -> int:
    """Where a term of the language ``block`` is counted."""
    return block * PLACES + (crc32(term.encode("utf-8", "surrogatepass")) & (PLACES - 1))


def sentences_of(text: str | None, lang: str | None = None) -> list[str]:
    """Sentences of a text; headings and pieces without a letter are none."""
    if not text:
        return []
    _, ends, size, _, _ = scan(text, alone=True, lang=lang)
    out, at = [], 0
    for cut in sorted({e for e, m in ends if m & 1} | {size}):
        piece = text[at:cut].strip()
        at = cut
        while piece.startswith("#"):
            piece = piece.partition("\n")[2].strip()
        if any(c.isalpha() for c in piece):
            out.append(piece)
    return out


def _offsets(sizes: list[int]) -> pa.Array:
    return pa.array(np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)]), pa.int32())


def _split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 1_000):
            part = batch.slice(at, 1_000)
            flat: list[int] = []
            per_sentence, per_doc = [], []
            for text in part.column(1).to_pylist():
                lang = language(text) if text else "other"
                base = LANGUAGES.index(lang) * PLACES
                found = sentences_of(text, lang)
                per_doc.append(len(found))
                for s in found:
                    own = {base + (crc32(t.encode("utf-8", "surrogatepass")) & (PLACES - 1)) for t in terms(s)}
                    per_sentence.append(len(own))
                    flat += sorted(own)
            sents = pa.ListArray.from_arrays(_offsets(per_sentence), pa.array(flat, pa.int32()))
            yield pa.RecordBatch.from_arrays([part.column(0), pa.ListArray.from_arrays(_offsets(per_doc), sents)], names=["_id", "_ids"])


#: Term occurrences that the E-step holds at once.
BATCH_TERMS = 50_000


def settled(flat: np.ndarray, sizes: np.ndarray, beta: np.ndarray, prior: np.ndarray) -> np.ndarray:
    """Topic proportions of items, whose terms are laid end to end, under the topics ``beta`` (place by topic) and ``prior`` (item by topic)."""
    theta = prior / prior.sum(1, keepdims=True)
    live = np.flatnonzero(sizes)
    own = np.repeat(np.arange(len(sizes)), sizes)
    b = beta[flat]
    starts = (np.cumsum(sizes) - sizes)[live]
    # Each step raises the likelihood, so steps grow small; items that have settled drop out.
    while len(live):
        share = theta[own] * b
        share /= share.sum(1, keepdims=True) + 1e-30
        new = prior[live] + np.add.reduceat(share, starts, axis=0)
        new /= new.sum(1, keepdims=True)
        moves = np.abs(new - theta[live]).max(1) >= SETTLED
        theta[live] = new
        if not moves.all():
            kept = np.repeat(moves, sizes[live])
            live, own, b = live[moves], own[kept], b[kept]
            starts = np.cumsum(sizes[live]) - sizes[live]
    return theta


def _row_of(known: np.ndarray) -> np.ndarray:
    """The row of each place among the known ones, -1 for others."""
    row = np.full(len(LANGUAGES) * PLACES, -1, np.int32)
    row[known] = np.arange(len(known))
    return row


def _documents(batch: pa.RecordBatch, row: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """(first document, one behind the last, rows of known terms, their number by sentence, sentences by document), BATCH_TERMS at a time."""
    docs = batch.column(batch.schema.get_field_index("_ids"))
    sents = docs.flatten()
    flat = row[sents.flatten().to_numpy(zero_copy_only=False)]
    keep = flat >= 0
    upto = np.concatenate([[0], np.cumsum(keep)])
    low, base = sents.offsets.to_numpy(), docs.offsets.to_numpy()
    low, base = upto[low - low[0]], base - base[0]
    flat, per_sentence = flat[keep], np.diff(low)
    ends = low[base[1:]]
    at = 0
    while at < batch.num_rows:
        begun = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, begun + BATCH_TERMS, "right")))
        yield at, to, flat[begun : ends[to - 1]], per_sentence[base[at] : base[to]], np.diff(base[at : to + 1])
        at = to


def _by_document(per_sentence: np.ndarray, per_doc: np.ndarray) -> np.ndarray:
    return np.diff(np.concatenate([[0], np.cumsum(per_sentence)])[np.concatenate([[0], np.cumsum(per_doc)])])


_SUMS = "chunk int, part int, sums binary"


def _rows(total: np.ndarray, part: int) -> Iterator[pa.RecordBatch]:
    """Sums (place by topic) as one row for each chunk of places that has any."""
    for c in range(0, len(total), CHUNK):
        if (piece := total[c : c + CHUNK]).any():
            own = np.flatnonzero(piece.any(1)).astype(np.int32)
            body = np.int32(len(own)).tobytes() + own.tobytes() + piece[own].astype(np.float32).tobytes()
            yield pa.RecordBatch.from_arrays([pa.array([c // CHUNK], pa.int32()), pa.array([part], pa.int32()), pa.array([body], pa.binary())], names=["chunk", "part", "sums"])


def _read(body: bytes, k: int) -> tuple[np.ndarray, np.ndarray]:
    n = int(np.frombuffer(body, np.int32, 1)[0])
    return np.frombuffer(body, np.int32, n, 4), np.frombuffer(body, np.float32, n * k, 4 + 4 * n).reshape(n, k)


def _sums(shared, k: int, alpha: float):
    """Topic-term sums of documents under (topics, known places); without either, the number of documents of each place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        beta, known = shared.value
        row = np.arange(len(LANGUAGES) * PLACES) if known is None else _row_of(known)
        total = np.zeros((len(row) if known is None else len(known), k), np.float32)
        for batch in batches:
            for _, _, flat, per_sentence, per_doc in _documents(batch, row):
                sizes = _by_document(per_sentence, per_doc)
                own = np.repeat(np.arange(len(sizes)), sizes)
                if beta is None:
                    once = np.unique(own * np.int64(len(row)) + flat) % len(row)
                    np.add.at(total, once, 1)
                    continue
                theta = settled(flat, sizes, beta, np.full((len(sizes), k), alpha, np.float32))
                share = theta[own] * beta[flat]
                share /= share.sum(1, keepdims=True) + 1e-30
                order = np.argsort(flat, kind="stable")
                places, at = np.unique(flat[order], return_index=True)
                if len(places):
                    total[places] += np.add.reduceat(share[order], at, axis=0)
        context = TaskContext.get()
        yield from _rows(total, context.partitionId() % 64 if context else 0)

    return run


def _added(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        acc: dict[int, np.ndarray] = {}
        part = 0
        for batch in batches:
            for c, part, body in zip(*(x.to_pylist() for x in batch.columns)):
                own, values = _read(body, k)
                acc.setdefault(c, np.zeros((CHUNK, k)))[own] += values
        for c, total in acc.items():
            for row in _rows(total, part):
                yield pa.RecordBatch.from_arrays([pa.array([c], pa.int32()), *row.columns[1:]], names=["chunk", "part", "sums"])

    return run


def _total(coded: DataFrame, shared, k: int, places: int) -> np.ndarray:
    """Sums over all documents, place by topic. Few tasks add up many documents each; beyond WIDE tasks sums meet in two steps."""
    sc = coded.sparkSession.sparkContext
    tasks = coded.rdd.getNumPartitions()
    few = max(1, min(tasks, 2 * sc.defaultParallelism))
    parts = coded.select("_ids").coalesce(few).mapInArrow(_sums(shared, k, ALPHA), _SUMS)
    if few > WIDE:
        parts = parts.repartition("chunk", "part").mapInArrow(_added(k), _SUMS)
    rows = parts.repartition("chunk").mapInArrow(_added(k), _SUMS).collect()  # bounded: places x topics
    total = np.zeros((places, k), np.float32)
    for r in rows:
        own, values = _read(r.sums, k)
        total[r.chunk * CHUNK + own] += values
    return total


class Topics:
    """A fitted model: known places, topics (row of a place by topic, each normal within a language), topics of each subject and limit of a sentence
    by language, and the rows of each topic's top terms by (language, topic)."""

    def __init__(self, known: np.ndarray, beta: np.ndarray, subject_of: np.ndarray, limits: np.ndarray, top: dict[tuple[int, int], np.ndarray]):
        self.known, self.beta, self.subject_of, self.limits, self.top = known, beta, subject_of, limits, top


def _normal(lam: np.ndarray, lang: np.ndarray) -> np.ndarray:
    whole = np.zeros((len(LANGUAGES), lam.shape[1]))
    np.add.at(whole, lang, lam)
    return (lam / np.maximum(whole[lang], 1e-30)).astype(np.float32)


def fit(coded: DataFrame, labels: DataFrame, subjects: list[str], rounds: int = ROUNDS, labelled: int = LABELLED) -> Topics:
    """LDA over all of ``coded`` (_id, _ids), started from at most ``labelled`` rows of ``labels`` (_id, subject).

    Languages have their own terms, so each topic is one distribution per language. A model has at most LANGUAGES x PLACES rows, so
    it may be broadcast; only rows of known places are.
    """
    spark = coded.sparkSession
    k, n = len(subjects) + OTHER_TOPICS, len(subjects)

    def share(*what):
        return spark.sparkContext.broadcast(what)

    every = share(None, None)
    counts = _total(coded, every, 1, len(LANGUAGES) * PLACES)[:, 0]
    every.destroy()
    known = np.flatnonzero(counts >= MIN_DOCS).astype(np.int32)
    row, lang, v = _row_of(known), known // PLACES, len(known)

    drawn = settle(labels.orderBy(F.xxhash64("_id"), "_id", "subject").limit(labelled))
    read = settle(coded.join(drawn.groupBy("_id").agg(F.collect_set("subject").alias("_own")), "_id"))
    seen = read.select(F.explode("_own").alias("subject"), (F.lit(1.0) / F.size("_own")).alias("_w"), F.array_distinct(F.flatten("_ids")).alias("_t")).select("subject", "_w", F.explode("_t").alias("term"))
    seeds = seen.groupBy("subject", "term").agg(F.sum("_w").alias("w")).toPandas()
    column = {s: i for i, s in enumerate(subjects)}
    at = row[seeds["term"].to_numpy(np.int64)]
    start = np.zeros((v, n), np.float32)
    np.add.at(start, (at[at >= 0], seeds["subject"].map(column).to_numpy(np.int64)[at >= 0]), seeds["w"].to_numpy(np.float32)[at >= 0])
    told = start.sum(1, keepdims=True)
    prior = start.sum(0, keepdims=True) / max(1e-9, start.sum())
    # What labels say of a term beyond chance: a term whose labels are spread as all labels are says nothing.
    pure = start / np.maximum(told, 1e-9)
    strong = ((pure > np.maximum(0.5, 2 * prior)) * pure * told / (told + 1)).astype(np.float32)
    docs = counts[known].astype(np.float32)[:, None]
    rng = np.random.default_rng(0)
    rest = (1 - np.minimum(1, strong.sum(1, keepdims=True))) * docs / OTHER_TOPICS
    lam = np.concatenate([ETA + strong * docs + 0.02 * docs, ETA + rest * rng.uniform(0.6, 1.4, (v, OTHER_TOPICS)).astype(np.float32)], 1)
    for _ in range(rounds):
        shared = share(_normal(lam, lang), known)
        lam = _total(coded, shared, k, v) + ETA
        shared.destroy()
    # Inspection, by language: a topic belongs to the subject that its top terms were labelled with, if they agree.
    subject_of = np.full((len(LANGUAGES), k), -1)
    tops: dict[tuple[int, int], np.ndarray] = {}
    for g in range(len(LANGUAGES)):
        places = np.flatnonzero(lang == g)
        mass = lam[places] / lam[places].sum(1, keepdims=True)
        for j in range(k):
            top = places[np.argsort(-(mass[:, j] * np.log1p(lam[places, j])))[:TOP_TERMS]]
            tops[g, j] = top
            votes = strong[top].sum(0)
            b = int(votes.argmax()) if n else 0
            if len(top) and n and votes[b] > 0.6 * votes.sum() and votes[b] > 0.1 * len(top):
                subject_of[g, j] = b
    model = Topics(known, _normal(lam, lang), subject_of, np.full(len(LANGUAGES), LIMIT), tops)
    model.limits = _limits(model, read, subjects)
    return model


def sentence_shares(model: Topics, batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(first document, sentences by document, sentence by subject, language by sentence): what the subjects' topics have of each sentence's proportions."""
    k, n = model.beta.shape[1], int(model.subject_of.max(initial=-1)) + 1
    for at, _, flat, per_sentence, per_doc in _documents(batch, _row_of(model.known)):
        own = np.repeat(np.arange(len(per_doc)), per_doc)
        theta = settled(flat, _by_document(per_sentence, per_doc), model.beta, np.full((len(per_doc), k), ALPHA, np.float32))
        folded = settled(flat, per_sentence, model.beta, (ALPHA + CONTEXT * theta[own]).astype(np.float32))
        # What the sentence's own terms say: the proportions without their prior.
        size = per_sentence[:, None] + CONTEXT + ALPHA * k
        said = np.maximum(folded * size - ALPHA - CONTEXT * theta[own], 0) / np.maximum(per_sentence[:, None], 1)
        starts = np.concatenate([[0], np.cumsum(per_sentence)])[:-1]
        lang = np.zeros(len(per_sentence), np.int64)
        some = per_sentence > 0
        lang[some] = model.known[flat[starts[some]]] // PLACES
        out = np.zeros((len(per_sentence), n), np.float32)
        for j in range(k):
            to = model.subject_of[lang, j]
            hit = some & (to >= 0)
            out[hit, to[hit]] += said[hit, j]
        yield at, per_doc, out, lang


def _limits(model: Topics, read: DataFrame, subjects: list[str]) -> np.ndarray:
    """By language, the limit of a sentence's proportions under which the labelled documents' subjects agree best with their labels (by F1)."""
    shared = read.sparkSession.sparkContext.broadcast(model)
    column = {s: i for i, s in enumerate(subjects)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = np.zeros((len(LANGUAGES), len(LIMITS), 3))
        for batch in batches:
            labelled = [{column[x] for x in own} for own in batch.column(batch.schema.get_field_index("_own")).to_pylist()]
            for at, per_doc, said, lang in sentence_shares(shared.value, batch):
                ends = np.cumsum(per_doc)
                for d, (end, size) in enumerate(zip(ends, per_doc)):
                    if not size:
                        continue
                    own, mine = labelled[at + d], said[end - size : end]
                    for i, limit in enumerate(LIMITS):
                        got = set(np.flatnonzero((mine >= limit).sum(0) >= SHARE * size))
                        score[lang[end - size : end].max(), i] += len(got & own), len(got), len(own)
        g, i = np.indices(score.shape[:2]).reshape(2, -1)
        flat = score.reshape(-1, 3)
        yield pa.RecordBatch.from_arrays([pa.array(g, pa.int32()), pa.array(i, pa.int32()), *[pa.array(flat[:, c], pa.float64()) for c in range(3)]], names=["g", "i", "both", "got", "own"])

    rows = read.mapInArrow(run, "g int, i int, both double, got double, own double").groupBy("g", "i").agg(F.sum("both"), F.sum("got"), F.sum("own")).collect()
    shared.destroy()
    score = np.zeros((len(LANGUAGES), len(LIMITS), 3))
    for g, i, *three in rows:
        score[g, i] = three
    score += OTHERS * score.sum(0, keepdims=True)
    out = np.full(len(LANGUAGES), LIMIT)
    for g in range(len(LANGUAGES)):
        f = 2 * score[g, :, 0] / np.maximum(score[g, :, 1] + score[g, :, 2], 1e-9)
        if f.any():
            out[g] = np.median(np.array(LIMITS)[f >= f.max() - 1e-9])
    return out


def prepare(df: DataFrame, key: str, text: str) -> DataFrame:
    """_id, _ids: coded terms by sentence."""
    kind = dict(df.dtypes)[key]
    return settle(df.select(F.col(key).alias("_id"), F.col(text).alias("_text")).mapInArrow(_split, f"_id {kind}, _ids array<array<int>>"))


def known_labels(labels: DataFrame, subjects: list[str], key: str) -> DataFrame:
    return labels.select(F.col(key).alias("_id"), normal("subject").alias("subject")).where(F.col("subject").isin(subjects) & F.col("_id").isNotNull()).distinct()


def proportions(df: DataFrame, labels: DataFrame, subjects: list[str], key: str = "doc_id", text: str = "text", **how: int) -> DataFrame:
    """key, subject, ``share``: of each row's sentences the share about each subject, 0 left out.

    ``labels``: key and subject; unknown subjects and null keys are left out, other spellings count, repeated rows once. Texts are read whole.
    Null, empty and blank texts are about nothing. Without labels no topic has a subject and the result is empty.
    Repeated keys are separate rows.
    """
    coded = prepare(df, key, text)
    shared = df.sparkSession.sparkContext.broadcast(fit(coded, known_labels(labels, subjects, key), subjects, **how))
    kind = coded.schema["_id"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            ids = batch.column(batch.schema.get_field_index("_id"))
            for at, per_doc, said, lang in sentence_shares(model, batch):
                about = np.concatenate([np.zeros((1, said.shape[1])), np.cumsum(said >= model.limits[lang][:, None], axis=0)])
                ends = np.cumsum(per_doc)
                share = (about[ends] - about[ends - per_doc]) / np.maximum(per_doc, 1)[:, None]
                doc, subject = np.nonzero(share)
                yield pa.RecordBatch.from_arrays([ids.take(pa.array(at + doc)), pa.array([subjects[j] for j in subject], pa.string()), pa.array(share[doc, subject], pa.float64())], names=[key, "subject", "share"])

    return coded.mapInArrow(run, f"`{key}` {kind.simpleString()}, subject string, share double")


def topic_terms(df: DataFrame, model: Topics, subjects: list[str], text: str = "text") -> DataFrame:
    """language, topic, ``subject`` (null if the topic belongs to none), ``rank``, ``term``: the top terms by which topics are mapped to subjects.

    A place is shown by the term that stands there in most sentences. Languages without known terms have no topics.
    """
    spark = df.sparkSession
    wanted = spark.sparkContext.broadcast({int(model.known[r]) for rows in model.top.values() for r in rows})  # bounded: languages x topics x TOP_TERMS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places = wanted.value
        seen: Counter = Counter()
        for batch in batches:
            for t in batch.column(0).to_pylist():
                lang = language(t) if t else "other"
                for s in sentences_of(t, lang):
                    seen.update((p, x) for x in terms(s) if (p := place(x, LANGUAGES.index(lang))) in places)
        yield pa.RecordBatch.from_arrays([pa.array([p for p, _ in seen], pa.int32()), pa.array([x for _, x in seen], pa.string()), pa.array(list(seen.values()), pa.int64())], names=["place", "term", "n"])

    counted = df.select(text).mapInArrow(run, "place int, term string, n bigint").groupBy("place", "term").agg(F.sum("n").alias("n"))
    named = counted.groupBy("place").agg(F.min(F.struct(-F.col("n"), "term"))["term"].alias("term"))
    rows = [(LANGUAGES[g], j, subjects[model.subject_of[g, j]] if model.subject_of[g, j] >= 0 else None, i, int(model.known[r])) for (g, j), rows in model.top.items() for i, r in enumerate(rows)]
    listed = spark.createDataFrame(rows, "language string, topic int, subject string, rank int, place int")
    return listed.join(named, "place").select("language", "topic", "subject", "rank", "term")


#: Subjects are columns of the model; more than this are refused, not cut.
MOST_SUBJECTS = 1_000


def _subjects(spark: SparkSession, sf_dir: str) -> list[str]:
    subjects = sorted(r.subject for r in table(spark, sf_dir, "subjects").select("subject").where("subject is not null").distinct().limit(MOST_SUBJECTS + 1).collect())
    if len(subjects) > MOST_SUBJECTS:
        raise ValueError("more subjects than a model can hold")
    return subjects


def _shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return proportions(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "doc_labels"), _subjects(spark, sf_dir))


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shares(spark, sf_dir).where(F.col("share") >= SHARE - 1e-9).select("doc_id", "subject")


def p9_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shares(spark, sf_dir)


def p9_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The topics with their top terms and subjects, for inspection."""
    docs, subjects = table(spark, sf_dir, "documents").select("doc_id", "text"), _subjects(spark, sf_dir)
    model = fit(prepare(docs, "doc_id", "text"), known_labels(table(spark, sf_dir, "doc_labels"), subjects, "doc_id"), subjects)
    return topic_terms(docs, model, subjects)


QUERIES = {"p9_found": p9_found, "p9_shares": p9_shares, "p9_topics": p9_topics}
SQL: dict[str, str] = {}
