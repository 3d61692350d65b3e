"""Quality rules from tokeniser fertility.

Public vocabularies encode every word of a text, as the word after a space.
Per text and vocabulary: characters per token, share of byte tokens (fallback
pieces, or tokens that are no whole UTF-8 text) and entropy of the tokens.  Per
language, or per script where the language is NULL, bands are set around the
median of all texts; a text outside a band of its group is rejected.
"""

from __future__ import annotations

import base64
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runlens.llm.textblocks import Block, Ragged, SpanNumbers, blocks, repeated, within_text
from runlens.plans.tables import write_table

TOKENIZERS = "/opt/tokenizers"
# Words with known counts kept by a worker; it starts anew when they are more.
CACHE_WORDS = 1_500_000


@dataclass(frozen=True)
class Vocabulary:
    """A vocabulary file; ``kind`` is ``sentencepiece`` or ``tiktoken``."""

    name: str
    kind: str
    path: str


VOCABULARIES = (
    Vocabulary("piece", "sentencepiece", f"{TOKENIZERS}/piece_bpe_32k.model"),
    Vocabulary("bytes", "tiktoken", f"{TOKENIZERS}/byte_bpe_multi_50k.tiktoken"),
)


@dataclass(frozen=True)
class Bands:
    """When a text is rejected.

    A deviation is the distance of a value from the median of its group in
    spreads (interquartile range / 1.35, at least ``min_spread`` of the median).
    Characters per token are held against the group, with the spread widened
    for texts shorter than the median; entropy, which grows with length, against the
    texts of the group in the same power of two of tokens.  A text is rejected
    if the mean of its deviations is below ``-mean``, one is below ``-single``,
    or its share of byte tokens exceeds the group's median by ``byte_share``.
    Groups and length classes of under ``min_texts`` texts set no band.
    """

    mean: float = 2.0
    single: float = 8.0
    byte_share: float = 0.2
    min_spread: float = 0.01
    min_texts: int = 30
    length_classes: tuple[int, int] = (5, 10)


class _Encoder:
    """Token ids of single words, each taken as following a space."""

    def __init__(self, vocabulary: Vocabulary):
        if vocabulary.kind == "sentencepiece":
            import sentencepiece
            model = sentencepiece.SentencePieceProcessor(model_file=vocabulary.path)
            self.size = model.get_piece_size()
            self.is_byte = np.array([model.is_byte(i) or model.is_unknown(i) for i in range(self.size)])
            self.encode = lambda words: model.encode(words, num_threads=1)
        else:
            import tiktoken
            from public_tokenizers import PATTERN
            with open(vocabulary.path, "rb") as lines:
                ranks = {base64.b64decode(t): int(r) for t, r in map(bytes.split, lines)}
            core = tiktoken.Encoding(vocabulary.name, pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})._core_bpe
            self.size = max(ranks.values()) + 1
            self.is_byte = np.zeros(self.size, bool)
            for token, rank in ranks.items():
                try:
                    token.decode()
                except UnicodeDecodeError:
                    self.is_byte[rank] = True
            self.encode = lambda words: [core.encode_ordinary(" " + w) for w in words]


class _WordTokens:
    """Token ids of the words seen by a worker."""

    def __init__(self, vocabularies: Sequence[Vocabulary]):
        self.encoders = {v.name: _Encoder(v) for v in vocabularies}
        self.seen = SpanNumbers(CACHE_WORDS)
        self.ids = {n: Ragged() for n in self.encoders}

    def find(self, block: Block) -> np.ndarray:
        """Numbers of the block's words; encodes those not seen yet."""
        starts, ends = block.spans
        if self.seen.full:
            self.seen.forget()
            self.ids = {n: Ragged() for n in self.encoders}
        numbers, new = self.seen.number(block.word_hash)
        if len(new):
            raw = block.data.tobytes()
            words = [raw[s:e].decode() for s, e in zip(starts[new].tolist(), ends[new].tolist())]
            for n, encoder in self.encoders.items():
                self.ids[n].extend(encoder.encode(words))
        return numbers


# One per worker and set of vocabularies: workers serve one task after the other.
_seen: dict[tuple[Vocabulary, ...], _WordTokens] = {}


_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"[#*$%&|<>]")] = True
_LEAD = (np.arange(256) & 0xC0) != 0x80
_NOT_SPACE = np.ones(256, bool)
_NOT_SPACE[[32, 9, 10, 11, 12, 13]] = False


def base_counts(block: Block) -> dict[str, np.ndarray]:
    """The plain counts of every text of a block."""
    n = block.n_texts
    starts, _ = block.spans
    cuts = np.union1d(block.offsets[:-1], np.flatnonzero(block.data == 10) + 1)
    cuts = cuts[cuts < len(block.data)]
    ends = np.append(cuts[1:], len(block.data))
    word_line = np.searchsorted(starts, ends) > np.searchsorted(starts, cuts)
    cuts, ends = cuts[word_line], ends[word_line]
    ends = ends - (block.data[ends - 1] == 10) if len(ends) else ends
    text = np.searchsorted(block.offsets, cuts, "right") - 1
    lines = np.unique(within_text(block.span_hash(cuts, ends), text), return_index=True)[1] if len(cuts) else cuts
    n_lines = np.bincount(text, minlength=n)
    distinct = np.bincount(text[lines], minlength=n) if len(cuts) else n_lines

    windows, at = block.shingles(8)
    twice = at[repeated(within_text(windows, block.text_of_word[at]))]
    cover = np.zeros(len(starts) + 9, np.int64)
    np.add.at(cover, twice, 1)
    np.add.at(cover, twice + 8, -1)
    covered = np.cumsum(cover)[: len(starts)] > 0
    return {
        "n_words": np.diff(block.first_word).astype(np.int64),
        "word_chars": block.count(_LEAD & _NOT_SPACE),
        "n_symbols": block.count(_SYMBOL),
        "n_dup_lines": (n_lines - distinct).astype(np.int64),
        "n_repeat_words": np.bincount(block.text_of_word[covered], minlength=n).astype(np.int64),
    }


def _entropy(text: np.ndarray, ids: np.ndarray, size: int, counts: np.ndarray) -> np.ndarray:
    """Entropy in bits of the token ids of each text."""
    keys = np.sort(text * size + ids)
    runs = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.empty(0, np.int64)
    c = np.diff(np.append(runs, len(keys))).astype(float)
    mass = np.bincount(keys[runs] // size, weights=c * np.log2(c), minlength=len(counts))
    n = np.maximum(counts, 1)
    return np.maximum(np.log2(n) - mass / n, 0.0)


def fertility_counts(block: Block, words: _WordTokens) -> dict[str, np.ndarray]:
    """Tokens, byte tokens and entropy of every text of a block, by vocabulary."""
    numbers, out, n = words.find(block), {}, block.n_texts
    for name, encoder in words.encoders.items():
        per_word, ids = words.ids[name].take(numbers)
        text = np.repeat(block.text_of_word, per_word)
        counts = np.bincount(text, minlength=n)
        out[f"{name}_tokens"] = counts.astype(np.int64)
        out[f"{name}_byte_tokens"] = np.bincount(text[encoder.is_byte[ids]], minlength=n).astype(np.int64)
        out[f"{name}_entropy"] = _entropy(text, ids, encoder.size, counts)
    return out


def measure(docs: DataFrame, vocabularies: Sequence[Vocabulary] = VOCABULARIES) -> DataFrame:
    """One row per row of ``docs`` (doc_id, lang, text) with all counts; no shuffle."""
    base = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    columns = [(c, "bigint") for c in base]
    for v in vocabularies:
        columns += [(f"{v.name}_tokens", "bigint"), (f"{v.name}_byte_tokens", "bigint"), (f"{v.name}_entropy", "double")]

    def run(batches):
        words = _seen.setdefault(tuple(vocabularies), None) or _WordTokens(vocabularies)
        _seen[tuple(vocabularies)] = words
        for batch in batches:
            for block in blocks(batch.column("text")):
                rows = batch.slice(block.first_row, block.n_texts)
                found = base_counts(block) | fertility_counts(block, words)
                yield pa.RecordBatch.from_arrays(
                    [rows.column("doc_id"), rows.column("band_group"), *[pa.array(found[c]) for c, _ in columns]],
                    ["doc_id", "band_group", *[c for c, _ in columns]])

    script = (F.when(F.col("text").rlike(r"\p{IsLatin}"), "latin").when(F.col("text").rlike(r"\p{IsCyrillic}"), "cyrillic")
              .when(F.col("text").rlike(r"\p{IsHan}"), "han").when(F.col("text").rlike(r"\p{L}"), "other").otherwise("none"))
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"),
                       F.coalesce(F.col("lang").cast("string"), F.concat(F.lit("script:"), script)).alias("band_group"))
    return rows.mapInArrow(run, "doc_id bigint, band_group string, " + ", ".join(f"{c} {t}" for c, t in columns))


def _centre(values: dict[str, str]) -> list:
    """Aggregates: quartiles of each column, under its new name."""
    return [F.percentile_approx(c, [0.25, 0.5, 0.75], 10_000).alias(n) for n, c in values.items()]


def apply_bands(measured: DataFrame, vocabularies: Sequence[Vocabulary] = VOCABULARIES, bands: Bands = Bands()) -> DataFrame:
    """Add ``base_failed``, the ratios of every vocabulary, their mean
    ``deviation``, ``rejected_by`` and ``kept``.

    ``measured`` is read three times, so it should be a stored table.  Bands are
    set by all texts of the group that pass the base rule.
    """
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    rows = measured.withColumn("base_failed", failed)
    for v in vocabularies:
        tokens = F.col(f"{v.name}_tokens")
        rows = (rows.withColumn(f"{v.name}_chars_per_token", F.try_divide(F.col("word_chars"), tokens))
                .withColumn(f"{v.name}_byte_share", F.try_divide(F.col(f"{v.name}_byte_tokens"), tokens)))
    names = [v.name for v in vocabularies]
    tokens = F.greatest(F.col(f"{names[0]}_tokens"), F.lit(1))
    shortest, longest = bands.length_classes
    rows = rows.withColumn("_class", F.least(F.greatest(F.floor(F.log2(tokens)), F.lit(shortest)), F.lit(longest)))
    passed = rows.where(~F.col("base_failed"))
    per_group = passed.groupBy("band_group").agg(
        F.count(F.lit(1)).alias("_n_group"), F.percentile_approx(tokens, 0.5, 10_000).alias("_typical"),
        *_centre({f"_{n}_{m}": f"{n}_{m}" for n in names for m in ("chars_per_token", "byte_share")}))
    per_class = passed.groupBy("band_group", "_class").agg(
        F.count(F.lit(1)).alias("_n_class"), *_centre({f"_{n}_entropy": f"{n}_entropy" for n in names}))
    rows = rows.join(per_group, "band_group", "left").join(per_class, ["band_group", "_class"], "left")

    widen = F.sqrt(F.greatest(F.lit(1.0), F.col("_typical") / tokens))
    deviations, high_bytes = {}, []
    for n in names:
        for measure_name, population, wide in (("chars_per_token", "_n_group", widen), ("entropy", "_n_class", F.lit(1.0))):
            q = F.col(f"_{n}_{measure_name}")
            spread = F.greatest((q[2] - q[0]) / 1.35, bands.min_spread * q[1], F.lit(1e-6)) * wide
            deviations[f"{n}_{measure_name}"] = F.when(
                F.col(population) >= bands.min_texts, (F.col(f"{n}_{measure_name}") - q[1]) / spread)
        high_bytes.append(F.when((F.col("_n_group") >= bands.min_texts) &
                                 (F.col(f"{n}_byte_share") > F.col(f"_{n}_byte_share")[1] + bands.byte_share),
                                 f"{n}_byte_share"))
    known = sum(F.when(d.isNotNull(), 1).otherwise(0) for d in deviations.values())
    total = sum(F.coalesce(d, F.lit(0.0)) for d in deviations.values())
    rows = rows.withColumn("deviation", F.coalesce(F.try_divide(total, known), F.lit(0.0)))
    reasons = [F.when(F.col("deviation") < -bands.mean, "mean"), *high_bytes,
               *[F.when(d < -bands.single, name) for name, d in deviations.items()]]
    rows = rows.withColumn("rejected_by", F.when(F.col("base_failed"), "base").otherwise(F.concat_ws(",", *reasons)))
    rows = rows.withColumn("kept", F.col("rejected_by") == "")
    return rows.drop(*[c for c in rows.columns if c.startswith("_")])


def tokenizer_fertility(docs: DataFrame, vocabularies: Sequence[Vocabulary] = VOCABULARIES, bands: Bands = Bands()) -> DataFrame:
    """Counts, ratios and verdict of every document.

    ``docs`` needs doc_id, text and lang; other columns, whatever their names,
    are ignored.  A NULL or empty text has no words and fails the base rule; a
    NULL language is replaced by the script; equal rows get equal results, one
    each; an empty table gives no row.
    """
    return apply_bands(write_table(measure(docs, vocabularies), "fertility"), vocabularies, bands)
