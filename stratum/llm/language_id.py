"""Language identification by cross-parsing entropy.

For each language of the labelled rows a suffix automaton holds a sample of its
text.  A text is parsed by each language in turn: a phrase is the longest match
from where the last one ended, read off the automaton, or one character that
the language's sample lacks.  A language's cost is the number of phrases times
the logarithm of its sample's length (the bits that name a phrase), by
character of the text.  The least cost wins, equal ones by the language's name.
The score is how far the next best lies above it, as a share of it: 0 where two
languages are equal, 1 from twice the cost on, and where only one was learned.
So a language's parse may stop, without any effect, once its cost has reached
``CLEAR`` times a whole parse's cost; the likeliest by the text's start comes first.

Texts are lower-cased and reduced to letters and marks, with one space for
whatever lies between them.  The sample holds at most ``PASSAGES`` distinct passages of ``PASSAGE``
code points a language, drawn by the smallest hashes from all passages of its
rows whose remainder (``crc32`` of ``doc_id`` as text, modulo 5) is not 0; a
passage has the same chance wherever it lies, and copies count once.  So what is
sent to the tasks is bounded for each language, and a text's time is its length
times the number of languages.

Defined cases: null texts and texts without a letter are ``und`` with score 0,
as is every text if no language was learned; rows without ``doc_id`` or ``lang``
are never learned from (``held_out`` is false for a null ``doc_id``); repeated
rows and repeated ids give a row each; other columns are ignored; an empty table
gives an empty result.
"""

from __future__ import annotations

import math
import unicodedata

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stratum.llm import text as T

FOLDS = 5
PASSAGES = 128          # of each language
PASSAGE = 512           # code points
OVERDRAW = 4            # passages drawn by hash for each one kept
UNKNOWN = "und"
CLEAR = 2               # costs this many times the least are as good as any higher
STRIDE = 256            # characters between looks at the cost


class _Fold(dict):
    """Each character lower-cased if it is a letter or a mark, else a space."""

    def __missing__(self, code: int) -> str:
        c = chr(code)
        self[code] = c.lower() if unicodedata.category(c)[0] in "LM" else " "
        return self[code]


_FOLD = _Fold()


def letters(text: str) -> str:
    """The text as it is parsed; empty if it has no letter."""
    own = " ".join(text.translate(_FOLD).split())
    return own if any(unicodedata.category(c)[0] == "L" for c in own) else ""


def remainder(doc_id):
    return F.crc32(doc_id.cast("string").cast("binary")) % FOLDS


class SuffixAutomaton:
    """Automaton of all substrings of the texts; states are dicts from a
    character to the next state."""

    def __init__(self, texts: list[str]):
        joined = "\n".join(texts)                  # parsed texts hold no line end: no match spans two
        self.bits = math.log2(len(joined) + 2)
        step, link, size = [{}], [-1], [0]
        last = 0
        for c in joined:
            new = len(step)
            step.append({})
            size.append(size[last] + 1)
            link.append(0)
            p = last
            while p >= 0 and c not in step[p]:
                step[p][c] = new
                p = link[p]
            if p >= 0:
                q = step[p][c]
                if size[q] == size[p] + 1:
                    link[new] = q
                else:
                    copy = len(step)
                    step.append(dict(step[q]))
                    size.append(size[p] + 1)
                    link.append(link[q])
                    while p >= 0 and step[p].get(c) == q:
                        step[p][c] = copy
                        p = link[p]
                    link[q] = link[new] = copy
            last = new
        for state in step:
            for c, to in state.items():
                state[c] = step[to]
        self.root = step[0]

    def phrases(self, text: str, limit: float = math.inf) -> int:
        """Phrases of the greedy parse: each the longest match, or a character
        that the sample lacks.  Beyond ``limit`` phrases the parse may stop."""
        root, lost, n = self.root, {}, 0
        state = lost
        for at in range(0, len(text), STRIDE):
            for c in text[at:at + STRIDE]:
                state = state.get(c)
                if state is None:
                    n += 1
                    state = root.get(c, lost)
            if n >= limit:
                break
        return n


def sample(docs: DataFrame, passages: int = PASSAGES) -> DataFrame:
    """``lang, passage, h``: the passages learned from, at most ``passages`` for
    each language.  Passages are drawn by their hash from all rows; only drawn
    ones are cut out of their texts, and copies are one before any group is
    gathered."""
    rows = docs.where(F.col("lang").isNotNull() & (remainder(F.col("doc_id")) != 0)).select(
        "lang", "text", F.xxhash64("text").alias("t"), F.ceil(F.char_length("text") / PASSAGE).alias("n")).where("n > 0")
    share = rows.groupBy(F.col("lang").alias("of")).agg((F.lit(float(OVERDRAW * passages)) / F.sum("n")).alias("share"))
    draw = lambda i: F.pmod(F.xxhash64(F.col("t"), i), F.lit(1 << 30))
    drawn = F.filter(F.sequence(F.lit(0).cast("long"), F.col("n") - 1), lambda i: draw(i) < F.col("share") * (1 << 30))
    # a row for each language, less than the sample that is sent to all tasks anyway
    cut = rows.join(F.broadcast(share), F.col("lang") == F.col("of")).select("lang", "text", "t", F.explode(drawn).alias("i")).select(
        "lang", F.substring("text", (F.col("i") * PASSAGE + 1).cast("int"), F.lit(PASSAGE)).alias("passage"), draw(F.col("i")).alias("h"))
    own = cut.groupBy("lang", "passage").agg(F.min("h").alias("h"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy("h", "passage"))
    return own.withColumn("place", place).where(F.col("place") <= passages).drop("place")


def learn(docs: DataFrame, passages: int = PASSAGES) -> dict[str, list[str]]:
    """Sampled texts of each language, as they are parsed."""
    found: dict[str, list[str]] = {}
    for r in sample(docs, passages).orderBy("lang", "h", "passage").toLocalIterator():       # passages by language at most
        if own := letters(r["passage"]):
            found.setdefault(r["lang"], []).append(own)
    return found


class Identifier:
    """Automata of all languages, in order of their names."""

    def __init__(self, samples: dict[str, list[str]]):
        self.languages = [(lang, SuffixAutomaton(samples[lang])) for lang in sorted(samples)]

    def identify(self, text: str | None) -> tuple[str, float]:
        """(language, score) of a text."""
        own = letters(text or "")
        if not own or not self.languages:
            return UNKNOWN, 0.0
        first = own[:STRIDE]
        order = sorted(self.languages, key=lambda x: x[1].phrases(first) * x[1].bits)
        costs, least = [], math.inf
        for lang, a in order:
            costs.append((a.phrases(own, CLEAR * least / a.bits) * a.bits, lang))
            least = min(least, costs[-1][0])
        costs.sort()
        return costs[0][1], min(1.0, (costs[1][0] / costs[0][0] - 1) / (CLEAR - 1)) if len(costs) > 1 else 1.0


_KNOWN: dict = {}


def identifier(sent) -> Identifier:
    """This worker's automata of a broadcast sample."""
    if _KNOWN.get("sent") is not sent:             # held, so that no other broadcast takes its address
        _KNOWN.update(sent=sent, made=Identifier(sent.value))
    return _KNOWN["made"]


def identify_languages(docs: DataFrame, passages: int = PASSAGES) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` for every row of ``docs``."""
    T.prepare(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(learn(docs.select("doc_id", "text", "lang"), passages))

    def run(batches):
        of = identifier(sent)
        for batch in batches:
            for part in T.split_batch(batch, "text"):
                found = [of.identify(t.as_py()) for t in part.column("text")]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("held_out"), pa.array([f[0] for f in found], pa.string()),
                                                  pa.array([f[1] for f in found], pa.float64())], ["doc_id", "held_out", "lang_pred", "score"])

    rows = docs.select("doc_id", F.coalesce(remainder(F.col("doc_id")) == 0, F.lit(False)).alias("held_out"), "text")
    return rows.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")
