"""Problem 9: text statistics of each document, outlier scores, natural prose.

The statistics of a document are computed from its whole text.  Those written
in sentences by more than half of their words (told by capitals, stops and
words of letters, in any language) are the reference of their language, which
is told by the text's own common words, not by a column.  Every value of every
document is ranked exactly among its language's reference values: equal values
are counted together first, then one range-partitioned sort with partition
offsets gives the number of reference values up to each value.  A text of a
language not told is ranked among the references of all languages.  The
empirical tail probabilities add up, as negative logarithms, to outlier scores;
``junk`` takes of some statistics the tail in which code, tables and made-up
words lie.  Its limit is the score that only a fixed share of the reference
documents exceeds, at every size of the corpus.  Prose is what stays within the
limit and, checked exactly, stands in sentences by more than half of its words.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ranking import positions
from .scratch import written

# Choices of this module: common words of four languages.
COMMON_WORDS = {
    "en": "a about after again all along also an and any are as at be because been before but by can could do does each for from had has have he her his how i if in into is it its more most much no not of on one only or other our out own rather same she should so some still such than that the their them then there these they this those to up us was we were what when where which while who why will with without would you your",
    "de": "aber alle als am an auch auf aus bei bis bitte das dass dem den der des die dies diese dieser doch durch ein eine einem einen einer er es für haben hat ich ihr im in ist jede jetzt kann kein keine man manchmal mehr mit muss nach nicht noch nur ob oder ohne sehr sein sich sie sind so uns und um unter vom von vor war warum was weil wenn wer wie wir wird wurde zu zum zur über",
    "fr": "à au aux avec ce ces cette comme dans de des donc du elle elles en entre est et être faut il ils je la le les leur lui mais même ne ni nous on ont ou où par parce pas plus pour quand que quel qui quoi sa sans se ses si sinon son sont sur tous tout toutes très trop un une vers vous",
    "es": "a al ante antes como con cuando de del desde donde dos el ella ellos en entre era es esa ese esta este está esto estos fue ha hay la las le les lo los más me mi muy nada no nos nunca o otra otro para pero por porque que quien qué se ser si sin sobre son su sus también tiene toda todo todos tras un una uno usted y ya",
}
LANGUAGES = tuple(COMMON_WORDS)
_COMMON = {k: frozenset(v.split()) for k, v in COMMON_WORDS.items()}
_ANY = {w: tuple(k for k in LANGUAGES if w in _COMMON[k]) for k in LANGUAGES for w in _COMMON[k]}

STATISTICS = ("word_count", "mean_word_length", "symbol_ratio", "punctuated_lines", "common_words", "sentence_words")
# Choices of this module: the tails that add up to ``junk``; the other statistics count in the other scores only.
JUNK_TAIL = {"mean_word_length": "right", "symbol_ratio": "right", "common_words": "left"}
UNKNOWN = "none"


@dataclass(frozen=True)
class ProseConfig:
    least_share: float = 0.5
    sentence_words: int = 4
    worded_share: float = 0.75  # of a line's or sentence's tokens made of letters
    outlier_share: float = 0.002  # of the reference documents that may lie beyond the limit


_BOM = chr(0xFEFF)
_LINE = re.compile(r"\r\n|[\n\r\v\f\x85" + chr(0x2028) + chr(0x2029) + "]")
_SEPARATOR = re.compile("[\x1c-\x1e]")
_TAG = re.compile(r"</?[A-Za-z!][^<>]*>|<!--|-->|" + _BOM)
_MARK = re.compile(r"""^[\s>#*/\-+|;%!"'`=~:]*(?:\(?\d{1,3}[.)]\s+)?""")
_CLOSE = re.compile(r"""(?<=[.!?…])["')\]»”’*_/`-]*(?:\s+|$)""")
_WORD = re.compile(r"^[^\w]*[^\W\d_]+(?:['’\-][^\W\d_]+)*[^\w]*$")
_STRIP = "\"'`.,;:!?¿¡…()[]{}<>«»“”‘’*_-/#|"
_ENDS = tuple(".!?…")
_ENDS_LINE = tuple(".!?…:;,")


class _Token:
    """What the statistics need of one whitespace-divided token."""

    __slots__ = ("common", "length", "letters", "upper", "word", "worded")

    def __init__(self, token: str):
        bare = token.strip(_STRIP)
        self.length = len(token)
        self.letters = sum(map(str.isalnum, token))
        self.word = bool(bare)
        self.worded = _WORD.match(token) is not None
        self.upper = bare[:1].isupper()
        self.common = _ANY.get(bare.lower(), ())


class _Tokens(dict):
    """Tokens seen lately, a bounded number of them."""

    def __missing__(self, token: str) -> _Token:
        if len(self) > 1 << 17:
            self.clear()
        made = self[token] = _Token(token)
        return made


_SEEN = _Tokens()


def _lines(text: str) -> list[str]:
    """Lines by every kind of line end; three separators that ``splitlines`` knows beside them end none."""
    return _LINE.split(text) if _SEPARATOR.search(text) else text.splitlines()


def sentence_share(text: str | list[str], config: ProseConfig = ProseConfig()) -> float:
    """Share of the words of a text, or of its lines, that stand in full sentences, whatever the language.

    A full sentence begins with a capital, ends with a stop, and consists of
    words of letters.  Lines are joined until a blank one or one that isn't made
    of words; tags and signs that lead a line are no words.
    """
    found, total, block = 0, 0, []

    def settle() -> None:
        nonlocal found
        for piece in _CLOSE.split(" ".join(block)):
            if not piece.rstrip().endswith(_ENDS):
                continue
            tokens = [t for t in [_SEEN[w] for w in piece.split()] if t.word]
            n = len(tokens)
            if n < config.sentence_words or not tokens[0].upper or sum(t.worded for t in tokens) < config.worded_share * n:
                continue
            found += n
        block.clear()

    for line in _lines(text) if isinstance(text, str) else text:
        tokens = line.split()
        # a line that begins with a letter and has no tag stays as it is
        if tokens and not tokens[0][0].isalpha() or "<" in line or "-->" in line or _BOM in line:
            line = _MARK.sub("", _TAG.sub(" ", line), count=1)
            tokens = line.split()
        total += len(tokens)
        if tokens and sum([_SEEN[t].worded for t in tokens]) >= config.worded_share * len(tokens):
            block.append(line)
        elif block:
            settle()
    if block:
        settle()
    return min(1.0, found / total) if total else 0.0


def statistics(text: str | None, config: ProseConfig = ProseConfig()) -> tuple:
    """Language and the six statistics; a null, empty or blank text has no words and zeros, in the language ``none``."""
    text = text or ""
    n = size = visible = letters = 0
    hits: Counter[str] = Counter()
    for token, many in Counter(text.split()).items():
        t = _SEEN[token]
        visible += many * t.length
        letters += many * t.letters
        if t.letters:
            n += many
            size += many * t.length
            for k in t.common:
                hits[k] += many
    symbols = 1 - letters / visible if visible else 0.0
    if not n:
        return (UNKNOWN, 0, 0.0, symbols, 0.0, 0.0, 0.0)
    language, most = min(hits.items(), key=lambda x: (-x[1], LANGUAGES.index(x[0])), default=(UNKNOWN, 0))
    if most < max(2, 0.05 * n):
        language = UNKNOWN
    every = _lines(text)
    lines = [s for line in every if (s := line.rstrip())]
    ended = len([s for s in lines if s.endswith(_ENDS_LINE)]) / len(lines)
    return (language, n, size / n, symbols, ended, most / n, sentence_share(every, config))


_STATS = "doc_id long, language string, word_count double, mean_word_length double, symbol_ratio double, punctuated_lines double, common_words double, sentence_words double"


def _measure(config: ProseConfig):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [statistics(t.as_py(), config) for t in batch.column(1)]
            if rows:
                language, *stats = map(list, zip(*rows, strict=True))
                stats = [pa.array(map(float, s), pa.float64()) for s in stats]
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(language), *stats], ["doc_id", "language", *STATISTICS])

    return run


def text_statistics(df: DataFrame, id_: str, text: str, config: ProseConfig = ProseConfig()) -> DataFrame:
    """One row of statistics for every row of ``df``; see :func:`statistics` for null and empty texts."""
    return df.select(F.col(id_).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(_measure(config), _STATS)


def tail_scores(stats: DataFrame, id_: str, group: str, columns: tuple[str, ...], junk: dict[str, str], reference: str, unknown: str = UNKNOWN) -> DataFrame:
    """``(id, left_score, right_score, outlier, junk)`` from exact ranks among the reference rows of each ``group``.

    ``reference`` names a boolean column.  left: (1 + reference values up to
    this one) / (1 + all of them); right: the same from this one on.  Rows of
    the group ``unknown`` are ranked among the references of all groups.  Scores
    are sums of negative logarithms; a null or NaN value adds nothing, nor does
    a group without references.  Repeated ids add up, so ids should be unique.
    """
    named = F.explode(F.array(*(F.struct(F.lit(c).alias("name"), F.col(c).alias("value")) for c in columns)))
    every = F.lit("*")
    own = F.when(F.col(group) == unknown, every).otherwise(F.concat(F.lit("="), F.col(group)))
    tall = stats.select(F.col(id_).alias("id"), own.alias("own"), F.coalesce(reference, F.lit(False)).alias("ref"), named.alias("s")).select("id", "own", "ref", "s.name", F.col("s.value").alias("value"))
    tall = tall.where(F.col("value").isNotNull() & ~F.isnan("value"))
    # a reference row counts in its own group and in the one of all groups
    placed = tall.select("name", "value", F.explode(F.when(F.col("ref"), F.array_distinct(F.array("own", every))).otherwise(F.array("own"))).alias("own"), F.col("ref").cast("long").alias("many"))
    counts = placed.groupBy(F.concat_ws("/", "name", "own").alias("class"), "value").agg(F.sum("many").alias("many"))
    upto = written(positions(counts, "class", ["value"], ["value", "many"], weight="many"), "tail-ranks")
    total = upto.groupBy("class").agg((F.max("position") + 1).alias("total"))  # a row for each statistic and language
    tails = upto.join(total, "class").select(
        "class", "value", (-F.log((F.col("position") + 1) / F.col("total"))).alias("l"), (-F.log((F.col("total") - F.col("position") + F.col("many")) / F.col("total"))).alias("r")
    )
    side = F.lit(0.0)
    for name, tail in junk.items():
        side = F.when(F.col("name") == name, F.col("l" if tail == "left" else "r")).otherwise(side)
    met = tall.select("id", "name", "value", F.concat_ws("/", "name", "own").alias("class")).join(tails, ["class", "value"])
    scored = met.groupBy("id").agg(F.sum("l").alias("left_score"), F.sum("r").alias("right_score"), F.sum(F.greatest("l", "r")).alias("outlier"), F.sum(side).alias("junk"))
    return scored.withColumnRenamed("id", id_)


def junk_limit(scored: DataFrame, share: float) -> float:
    """The least ``junk`` of ``scored(doc_id, junk)`` that no more than ``share`` of the rows exceed; infinite for no rows."""
    ranked = written(positions(scored.select("doc_id", "junk", F.lit(0).alias("all")), "all", ["junk", "doc_id"], ["junk"]), "junk-ranks")
    n = ranked.count()
    found = ranked.where(F.col("position") >= math.ceil((1 - share) * n)).agg(F.min("junk")).first()[0]
    return math.inf if found is None else found


def prose_scores(df: DataFrame, id_: str, text: str, config: ProseConfig = ProseConfig()) -> DataFrame:
    """Statistics, scores and the verdict ``prose`` of every document.

    Rows without an id are left out; of rows with one id, one counts.  Null,
    empty and blank texts have no words and are no prose.  Other columns of
    ``df`` don't matter, whatever their names.
    """
    stats = text_statistics(df.where(F.col(id_).isNotNull()), id_, text, config).dropDuplicates(["doc_id"])
    stats = written(stats.withColumn("reference", (F.col("sentence_words") > config.least_share) & (F.col("language") != UNKNOWN)), "text-statistics")
    scores = tail_scores(stats, "doc_id", "language", STATISTICS, JUNK_TAIL, "reference")
    scored = written(stats.join(scores, "doc_id"), "text-scores")
    limit = junk_limit(scored.where("reference"), config.outlier_share)
    prose = (F.col("junk") <= limit) & (F.col("sentence_words") > config.least_share)
    return scored.drop("reference").withColumn("prose", prose)
