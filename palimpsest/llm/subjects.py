"""Subjects of texts: classifier chains over term, source and structure features, decoded by beam search.

Training sees readers' labels of a bounded sample of documents. Sentences of labelled documents are shared out among the document's subjects and
``none`` by expectation-maximisation, which gives each term a weight per subject. What a document's sentences then look
like (the share won by each subject, term sums, source, structure) are the features of one calibrated
logistic link per subject; a link also sees the subjects decided before it, so
co-occurrence is modelled, and beam search finds the likeliest combination. Links are fitted on features of documents that the term weights
behind these features have not seen (each half of the sample by the weights of the other), so they are calibrated for new documents.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palimpsest.llm.words import groups, hash_words, laid_out
from palimpsest.session import remove, stage

#: At most this many labelled documents are used for fitting (documented bound); features of all documents are made alike.
SAMPLE_DOCUMENTS = 20_000
#: ... and at most so many characters of them, whole texts in order of the sample; a text that doesn't fit is passed over.
SAMPLE_CHARACTERS = 60_000_000
#: Columns for sources. Sources of the sample share columns in turn if there are more; none is left out.
SOURCE_COLUMNS = 64
BUCKET_BITS = 22
LEAST = 1 / 3
_ENVIRONMENTS = ("verbatim", "lstlisting", "equation", "align", "tabular", "table")
#: What holds no sentences: opening sign, closing sign, the whole.
_BLOCKS = (
    *((f"<{t}", f"</{t}", re.compile(rf"<{t}\b[^<>]*>.*?</{t}\s*>", re.S | re.I)) for t in ("pre", "source", "syntaxhighlight", "math")),
    *((f, f, re.compile(rf"^({f}+)[^\n]*\n.*?^\1[ \t]*$", re.S | re.M)) for f in ("```", "~~~")),
    *((f"\\begin{{{e}", f"\\end{{{e}", re.compile(rf"\\begin\{{{e}\*?\}}.*?\\end\{{{e}\*?\}}", re.S)) for e in _ENVIRONMENTS),
    ("{|", "|}", re.compile(r"^\{\|.*?^\|\}", re.S | re.M)),
)
_NOTES = (("<ref", "/>", re.compile(r"<ref\b[^<>]*/>")), ("<ref", "</ref", re.compile(r"<ref\b[^<>]*>.*?</ref\s*>", re.S)), ("{{", "}}", re.compile(r"\{\{[^{}]*\}\}")), ("://", "", re.compile(r"https?://\S+")))
_BARE = re.compile(r"^(?:```+|~~~+)[ \t]*$", re.M)
_LIST = re.compile(r"^[ \t]*(?:[*+-]+|#[*#:]*|[:;]+|\d+[.)]|\(\d+\)|\\item|<li\b[^>]*>)[ \t]*\S", re.M)


def _without(text: str, parts, mark: str) -> str:
    """The text with each of ``parts`` replaced. Only what stands before the last closing sign is searched, so openings without end cost nothing."""
    small = None
    for opening, closing, whole in parts:
        if opening[0] == "<":
            if "<" not in text:
                continue
            small = text.lower() if small is None else small
        where = small if opening[0] == "<" and small is not None and len(small) == len(text) else text
        if opening == closing and opening in text:  # a fence: ended by a line of nothing else
            bare = [m.start() for m in _BARE.finditer(text)]
            end = bare[-1] if bare else -1
        else:
            end = where.rfind(closing) if opening in where else -1
        if end >= 0:
            last = {"<": ">", "\\": "}"}.get(opening[0], "")  # a closing tag or command ends at this sign, however far
            end = len(text) if not closing else end + len(closing)
            end = (text.find(last, end) + 1 or len(text)) if last and end < len(text) else end
            text, small = whole.sub(mark, text[:end]) + text[end:], None
    return text


def plain(text: str) -> str:
    """The text without blocks that hold no sentences and without notes; list items end like sentences."""
    return _without(_without(text, _BLOCKS, "\n"), _NOTES, " ")


def _sentences(texts: list[str]):
    """(word hash, sentence number, text number of each sentence) of countable sentences.

    A sentence ends at . ! or ? before white space or at a line end; a line end counts as an end only of a list item.
    """
    joined, points, offsets = laid_out([plain(t) for t in texts])
    h, of, start, end = hash_words(points, offsets)
    n = len(points)
    stop = (points == 46) | (points == 33) | (points == 63)
    nxt = np.empty(n, np.uint32)
    nxt[:-1], nxt[-1] = points[1:], 10
    line = points == 10
    stop &= (nxt == 32) | (nxt == 10) | (nxt == 60) | (nxt == 39) | (nxt == 42) | (nxt == 125) | (nxt == 9) | (nxt == 91) | (nxt == 96)
    # The point after an item's number ends nothing.
    breaks, dots = np.flatnonzero(line), np.flatnonzero(stop & (points == 46))
    before = np.searchsorted(breaks, dots)
    width = dots - np.where(before > 0, breaks[before - 1] + 1 if len(breaks) else 0, 0)
    numbered = (width >= 1) & (width <= 3)
    for k in (1, 2, 3):
        numbered &= (width < k) | ((points[dots - k] >= 48) & (points[dots - k] <= 57))
    stop[dots[numbered]] = False
    cut = stop | line
    number = np.cumsum(cut)[start] if len(start) else np.empty(0, np.int64)
    if not len(start):
        return h, number, np.empty(0, np.int64)
    firsts = np.flatnonzero(np.r_[True, (number[1:] != number[:-1]) | (of[1:] != of[:-1])])
    lasts = np.r_[firsts[1:], len(start)] - 1
    # Which cut ends the segment: a stop, or the line end of a list item.
    at = np.flatnonzero(cut)
    ends = at[np.searchsorted(at, end[lasts] - 1, "right")]
    stopped = stop[ends]
    line_at = np.flatnonzero(line)
    line_of = np.searchsorted(line_at, start[firsts], "left")
    line_start = np.where(line_of > 0, line_at[line_of - 1] + 1, 0)
    lead = points[line_start]
    listed = np.isin(lead, np.frombuffer("*+-#(:;\\<0123456789 \t".encode("utf-32-le"), np.uint32))
    maybe = np.flatnonzero(listed & ~stopped)
    keep = stopped.copy()
    for i in maybe.tolist():  # few: list items without a full stop
        at = int(line_start[i])
        keep[i] = bool(_LIST.match(joined, at)) and not (joined[at] == "#" and _is_heading(joined, at))
    seg = np.zeros(len(start), np.int64)
    seg[firsts] = 1
    seg = np.cumsum(seg) - 1
    words = keep[seg]
    renumber = np.cumsum(keep) - 1
    return h[words], renumber[seg[words]], of[firsts[keep]]


def _is_heading(text: str, at: int) -> bool:
    """Is the line that begins with ``#`` a Markdown heading? Items stand in rows of such lines, headings by themselves."""
    stop = text.find("\n", at)
    before = text.rfind("\n", 0, max(0, at - 1)) + 1 if at else 0
    return not (at and text[before : before + 1] in ("#", "*") or text[stop + 1 : stop + 2] in ("#", "*") and stop >= 0)


def _bucket(h):
    return (h >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)


def _structure(text: str, source: str | None) -> list[float]:
    """Features of form: length, lines, lists, headings."""
    n = len(text)
    return [np.log1p(n), text.count("\n\n") / (1 + n / 500), float("\n*" in text or "\n#" in text or "<li" in text), float("==" in text or "<h" in text or "\\section" in text)]


def canonical_source(source: str | None) -> str:
    return (source or "").strip().lower()


def canonical_lang(lang: str | None) -> str:
    """First two letters, which the usual spellings of one language share."""
    return (lang or "").strip().lower()[:2]


@dataclass
class Model:
    subjects: list[str]
    sources: dict[str, int]  # column of each source of the sample
    index: np.ndarray  # bucket -> row of weights, or -1
    weights: np.ndarray  # rows x (subjects + 1), the last column is none
    links: np.ndarray  # subjects x (features + earlier subjects + 1)
    order: list[int]
    beam: int = 4


def _em(words, sentence, sent_doc, given, langs, rounds: int = 15, smooth: float = 0.15):
    """Term weights log P(term | class) / P(term) by EM over sentences; ``given``: documents x subjects, ``langs``: documents' stated languages.

    A subject that readers gave fills at least a third of its document, but others may have sentences in it, and a document
    without subject may be a mixture of many: ``prior`` only leans towards what was given. At first the sentences of a document are
    shared among its given classes. Totals are kept per language of the term: classes have unequal shares of
    the languages, and a language's common words must not speak for a class.
    """
    labelled = given.any(1)
    k = given.shape[1] + 1
    prior = np.full((len(given), k), 0.03)
    prior[:, :-1][given] = 1.0
    prior[:, -1] = np.where(labelled, 0.3, 0.6)
    vocab, word = np.unique(words, return_inverse=True)
    n_sent, n_vocab = len(sent_doc), len(vocab)
    count = np.bincount(word, minlength=n_vocab).astype(float)
    names, lang = np.unique(np.asarray(langs, dtype=object).astype(str), return_inverse=True)
    of = np.stack([np.bincount(word, weights=(lang[sent_doc] == i)[sentence].astype(float), minlength=n_vocab) for i in range(len(names))], 1)
    per = of / of.sum(0, keepdims=True).clip(1)
    per[:, names == ""] = 0  # documents without a language say nothing about a term's
    per = per**2 + 1e-18
    per /= per.sum(1, keepdims=True)
    total = per @ (per.T @ count)  # of each term's language
    # Documents a term stands in: names fill their own document but few others, and the more documents the more names.
    spread = np.bincount(np.unique(word.astype(np.int64) * len(given) + sent_doc[sentence]) // len(given), minlength=n_vocab)
    own = np.hstack([given.astype(float), ~labelled[:, None]])[sent_doc]
    post = own / own.sum(1, keepdims=True)
    weights = None
    # Wording of none is learned from documents without subject only, or subjects' common wording would drift into it.
    bare = (~labelled[sent_doc]).astype(float) if (~labelled).any() else np.ones(n_sent)
    for _ in range(rounds):
        post[:, -1] *= bare
        by = np.stack([np.bincount(word, weights=post[sentence, c], minlength=n_vocab) for c in range(k)], 1)
        # Against what the class's share of the language would give the term: a rare term says little either way.
        weights = np.log((by + smooth) / (count[:, None] * (per @ (per.T @ by)) / total[:, None] + smooth))
        weights[(count < 2) | (spread < len(given) / 3000)] = 0
        score = np.stack([np.bincount(sentence, weights=weights[word, c], minlength=n_sent) for c in range(k)], 1)
        part = np.zeros((len(given), k))
        np.add.at(part, sent_doc, post)
        part += 2 * prior
        score += np.log(part / part.sum(1, keepdims=True))[sent_doc]
        e = np.exp(score - score.max(1, keepdims=True))
        post = e / e.sum(1, keepdims=True)
    return vocab, weights


def _won(words_rows, sentence, sent_doc, n_docs, weights):
    """Per document: share of sentences won by each class, mean margin of its best sentences, number of sentences."""
    n_sent, k = len(sent_doc), weights.shape[1]
    ok = words_rows >= 0
    score = np.zeros((n_sent, k), np.float32)
    if ok.any():
        rows, sent = words_rows[ok], sentence[ok]
        cut = np.flatnonzero(np.r_[True, sent[1:] != sent[:-1]])
        score[sent[cut]] = np.add.reduceat(weights[rows].astype(np.float32), cut, axis=0)
    best = score.argmax(1) if n_sent else np.empty(0, np.int64)
    if n_sent:
        best[score.max(1) <= score[:, -1] + 0.3] = k - 1
    count = np.bincount(sent_doc * k + best, minlength=n_docs * k).reshape(n_docs, k).astype(np.float64)
    n = count.sum(1)
    soft = np.zeros((n_docs, k))
    if n_sent:
        e = np.exp(np.clip(score - score.max(1, keepdims=True), -30, 0))
        np.add.at(soft, sent_doc, e / e.sum(1, keepdims=True))
    return count / np.maximum(n, 1)[:, None], soft / np.maximum(n, 1)[:, None], n


def features(texts, sources, model_index, weights, source_names):
    """Rows of document features: shares, soft shares, closeness to the least share, sentences, structure, source."""
    out, width = [], max(source_names.values(), default=-1) + 1
    for a, b in groups(texts):
        h, sentence, sent_doc = _sentences(texts[a:b])
        share, soft, n = _won(model_index[_bucket(h)], sentence, sent_doc, b - a, weights)
        form = np.array([_structure(t, s) for t, s in zip(texts[a:b], sources[a:b], strict=True)]).reshape(b - a, -1)
        src = np.zeros((b - a, width))
        known = [(i, source_names[s]) for i, s in enumerate(sources[a:b]) if s in source_names]
        src[[i for i, _ in known], [c for _, c in known]] = 1
        out.append(np.hstack([share, soft, np.log1p(n)[:, None], form, src]))
    return np.vstack(out) if out else np.zeros((0, 2 * weights.shape[1] + 5 + width))


def _link_input(x, k, subjects, earlier):
    """Input of one link: its own share as steps around the least share, then the rest, then earlier subjects."""
    own = x[:, k]
    near = np.stack([np.ones(len(x)), own - LEAST, np.clip((own - LEAST) * 8, -1, 1), own >= LEAST - 1e-9], 1)
    return np.hstack([near, x[:, [subjects + 1 + k]], x[:, 2 * (subjects + 1) :], earlier])


#: What the definition says before any label is seen: the steps of ``_link_input``'s first columns.
_PRIOR = np.array([-1.5, 4.0, 3.0, 3.0])


def _fit_link(z, y, strength: float = 8.0, rounds: int = 40):
    """Logistic regression by damped Newton steps towards the definition as its prior; its probabilities are calibrated by likelihood."""
    centre = np.zeros(z.shape[1])
    centre[: len(_PRIOR)] = _PRIOR

    def loss(w):
        t = z @ w
        return float((np.logaddexp(0, t) - y * t).sum() + strength / 2 * ((w - centre) ** 2).sum())

    w = centre.copy()
    now = loss(w)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        g = z.T @ (p - y) + strength * (w - centre)
        hess = (z * (p * (1 - p))[:, None]).T @ z + strength * np.eye(len(w))
        step, size = np.linalg.solve(hess, g), 1.0
        while (after := loss(w - size * step)) > now and size > 1e-4:
            size /= 2
        if after >= now - 1e-9:
            break
        w, now = w - size * step, after
    return w


def _unseen_features(texts, sources, names, words, sentence, sent_doc, given, langs):
    """Features of each half of the documents by term weights of the other half."""
    n, half = len(texts), np.arange(len(texts)) % 2
    out = None
    for side in (0, 1):
        docs = np.flatnonzero(half != side)
        if not len(docs):
            docs = np.arange(n)
        place = np.full(n, -1)
        place[docs] = np.arange(len(docs))
        kept = place[sent_doc] >= 0
        number = np.cumsum(kept) - 1
        mine = kept[sentence]
        vocab, weights = _em(words[mine], number[sentence[mine]], place[sent_doc[kept]], given[docs], [langs[i] for i in docs])
        index = np.full(1 << BUCKET_BITS, -1, np.int32)
        index[vocab] = np.arange(len(vocab))
        rest = np.flatnonzero(half == side)
        x = features([texts[i] for i in rest], [sources[i] for i in rest], index, weights, names)
        out = np.zeros((n, x.shape[1])) if out is None else out
        out[rest] = x
    return out


def train(texts: list[str], sources: list[str], langs: list[str], given: list[set[str]], subjects: list[str]) -> Model:
    """Fit on labelled texts. ``given``: the subjects that readers gave; an empty set is ``none``."""
    subjects = sorted(subjects)
    k = len(subjects)
    at = {s: i for i, s in enumerate(subjects)}
    y = np.zeros((len(texts), k))
    for i, g in enumerate(given):
        for s in g:
            if s in at:
                y[i, at[s]] = 1
    src = [canonical_source(s) for s in sources]
    names = {s: i % SOURCE_COLUMNS for i, s in enumerate(sorted(set(src)))}
    ws, ss, ds, base_s, base_d = [], [], [], 0, 0
    for a, b in groups(texts):
        h, sentence, doc = _sentences(texts[a:b])
        ws.append(_bucket(h))
        ss.append(sentence + base_s)
        ds.append(doc + base_d)
        base_s, base_d = base_s + len(doc), base_d + b - a
    words = np.concatenate(ws) if ws else np.empty(0, np.int64)
    index = np.full(1 << BUCKET_BITS, -1, np.int32)
    if len(words):
        sentence, sent_doc, spoken = np.concatenate(ss), np.concatenate(ds), [canonical_lang(x) for x in langs]
        del ws, ss, ds
        x = _unseen_features(texts, src, names, words, sentence, sent_doc, y > 0, spoken)
        vocab, weights = _em(words, sentence, sent_doc, y > 0, spoken)
        index[vocab] = np.arange(len(vocab))
    else:
        weights = np.zeros((1, k + 1))
        x = features(texts, src, index, weights, names)
    order = np.argsort(-y.sum(0), kind="stable").tolist()  # the commonest subjects first
    links, done = [], []
    for s in order:
        z = _link_input(x, s, k, y[:, done])
        links.append(_fit_link(z, y[:, s]) if len(x) else np.r_[_PRIOR, np.zeros(z.shape[1] - len(_PRIOR))])
        done.append(s)
    width = max((len(w) for w in links), default=0)
    return Model(subjects, names, index, weights, np.array([np.r_[w, np.zeros(width - len(w))] for w in links]), order)


def decode(model: Model, x):
    """Likeliest subject combinations (documents x subjects) by beam search along the chain."""
    n, k = len(x), len(model.subjects)
    states, scores = [np.zeros((n, k))], [np.zeros(n)]
    for i, s in enumerate(model.order):
        grown, value = [], []
        for st, sc in zip(states, scores, strict=True):
            z = _link_input(x, s, k, st[:, model.order[:i]])
            p = 1 / (1 + np.exp(-np.clip(z @ model.links[i][: z.shape[1]], -30, 30)))
            for bit, lp in ((0, np.log(1 - p + 1e-12)), (1, np.log(p + 1e-12))):
                new = st.copy()
                new[:, s] = bit
                grown.append(new)
                value.append(sc + lp)
        v = np.stack(value, 1)
        top = np.argsort(-v, 1, kind="stable")[:, : model.beam]
        g = np.stack(grown, 1)
        rows = np.arange(n)
        states = [g[rows, top[:, j]] for j in range(top.shape[1])]
        scores = [v[rows, top[:, j]] for j in range(top.shape[1])]
    return states[0]


def fit(docs: DataFrame, labels: DataFrame, subjects: DataFrame, sample: int = SAMPLE_DOCUMENTS) -> Model:
    """Train on at most ``sample`` labelled documents, taken by hash of the id; their texts come to the driver.

    Readers' labels are joined per document: a subject counts if at least half of its readers gave it; ``none`` alone is no subject.
    """
    names = [r[0] for r in subjects.select("subject").dropna().distinct().collect()]
    lab = labels.dropna(subset=["doc_id", "subject"])
    readers = lab.groupBy("doc_id").agg(F.countDistinct(F.coalesce("annotator", F.lit(""))).alias("readers"))
    votes = lab.groupBy("doc_id", "subject").agg(F.countDistinct(F.coalesce("annotator", F.lit(""))).alias("votes"))
    agreed = votes.join(readers, "doc_id").filter("2 * votes >= readers").groupBy("doc_id").agg(F.collect_set("subject").alias("given"))
    chosen = agreed.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    sample_rows = docs.select("doc_id", "text", "source", "lang").filter("text IS NOT NULL").join(F.broadcast(chosen), "doc_id")
    written, path = stage(sample_rows, "labelled")  # the one scan of the corpus; at most ``sample`` texts
    total, ids, least = 0, [], None
    for doc_id, size in written.select("doc_id", F.char_length("text")).orderBy(F.xxhash64("doc_id"), "doc_id").collect():  # two integers a sampled document
        least = (size, doc_id) if least is None else min(least, (size, doc_id))
        if total + size <= SAMPLE_CHARACTERS:
            total += size
            ids.append((doc_id,))
    ids = ids or ([(least[1],)] if least else [])
    within = docs.sparkSession.createDataFrame(ids, "doc_id long").distinct()
    rows = written.join(F.broadcast(within), "doc_id", "left_semi").orderBy("doc_id").collect()
    remove(docs.sparkSession, path)
    return train([r["text"] for r in rows], [r["source"] for r in rows], [r["lang"] for r in rows], [set(r["given"]) - {"none"} for r in rows], names)


def assign(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, subject) for every document with a subject. NULL and empty texts have none."""
    bc = docs.sparkSession.sparkContext.broadcast(model)  # bounded: the term table has 2**22 entries and the sample's terms

    def run(batches):
        import pandas as pd

        for pdf in batches:
            m = bc.value
            texts, src = pdf["text"].tolist(), [canonical_source(s) for s in pdf["source"]]
            if not texts:
                continue
            y = decode(m, features(texts, src, m.index, m.weights, m.sources))
            d, s = np.nonzero(y > 0.5)
            yield pd.DataFrame({"doc_id": pdf["doc_id"].to_numpy()[d], "subject": pd.Series([m.subjects[i] for i in s], dtype=object)})

    return docs.filter("text IS NOT NULL AND doc_id IS NOT NULL").select("doc_id", "text", "source").mapInPandas(run, "doc_id long, subject string")
