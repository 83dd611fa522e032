"""Training-set preparation: chat formatting, loss spans, splits, token statistics, BPE merges,
vocabulary, truncation, packing, masking, token budgets, pair tasks, and fill augmentation."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from svgspark.functions.text import uniform01
from svgspark.operators import select as S
from svgspark.operators import tree as T
from svgspark.operators.normalize import svg_text

# Chat template markers.
SYSTEM_TEXT = "You are Qwen, created by Alibaba Cloud. You are a helpful assistant."
USER_TEXT = "Generate SVG image based on the input caption.\nCaption: "
IM_START, IM_END = "<|im_start|>", "<|im_end|>"
INSTRUCTION_MARK = "<|im_start|>user\n"
RESPONSE_MARK = "<|im_start|>assistant\n"

# Special tokens (tag forms, attributes, namespace URLs), in their listed order.
SVG_TAG_NAMES = ["svg", "path", "rect", "circle", "ellipse", "line", "polyline", "polygon", "g", "defs",
                 "linearGradient", "radialGradient", "stop", "text", "tspan"]
SVG_TAGS = [f for t in SVG_TAG_NAMES for f in (f"<{t}>", f"</{t}>", f"<{t}")]
SVG_ATTRIBUTES = ["width", "height", "viewBox", "preserveAspectRatio", "x", "y", "dx", "dy", "cx", "cy", "r", "rx", "ry",
                  "fill", "fill-rule", "fill-opacity", "stroke", "stroke-width", "stroke-linecap", "stroke-linejoin",
                  "stroke-miterlimit", "stroke-dasharray", "stroke-dashoffset", "opacity", "d", "points", "transform",
                  "translate", "rotate", "scale", "skewX", "skewY", "matrix", "clip-path", "mask", "filter",
                  "gradientUnits", "gradientTransform", "spreadMethod", "stop-color", "stop-opacity", "offset",
                  "id", "class", "style", "role", "aria-label", "xmlns"]
XMLNS_URLS = ["http://www.w3.org/2000/svg", "http://www.w3.org/1999/xlink"]
SPECIAL_TOKENS = SVG_TAGS + SVG_ATTRIBUTES + XMLNS_URLS
# Units of markup that can be a special token: see special_token_counts.
SPECIAL_UNIT_RE = (r"</[A-Za-z][\w.:-]*>|<[A-Za-z][\w.:-]*>?|" + "|".join(u.replace(".", "[.]") + r"\b" for u in XMLNS_URLS)
                   + r"|[A-Za-z][\w.-]*\s*[=(]")
BASE_SPECIALS = ["[UNK]", "[CLS]", "[SEP]", "[PAD]", "[MASK]"]
VOCAB_TARGET = 50280 * 4 - 21
PRETOKEN_RE = r"\p{L}+|\p{N}+|[^\s\p{L}\p{N}]+"
MIN_FREQUENCY = 3
_INSIDE = r"[\p{L}\p{N}]"
_MARKS = rf"(?:</(?:{'|'.join(SVG_TAG_NAMES)})>|<(?:{'|'.join(SVG_TAG_NAMES)})(?:>|(?!{_INSIDE})))"
_NAMES = "|".join(sorted((u.replace(".", "[.]") for u in SVG_ATTRIBUTES + XMLNS_URLS), key=len, reverse=True))
#: Pre-tokens of the learned vocabulary: a special token that is not part of a longer word is one unit, the rest as PRETOKEN_RE.
UNIT_RE = rf"{_MARKS}|(?<!{_INSIDE})(?:{_NAMES})(?!{_INSIDE})|\p{{L}}+|\p{{N}}+|(?:(?!{_MARKS})[^\s\p{{L}}\p{{N}}])+"
#: Pairs that reach the driver in a round, and the share of the round's largest count that a pair needs.
MERGES_PER_ROUND = 32768
ROUND_SHARE = 0.5
#: Single characters are numbered by their code point, learned tokens from here on.
FIRST_TOKEN = 0x110000
#: Words of more symbols are merged one by one, with a heap; the others together, by arrays.
LONG_WORD = 256
#: Pairs of symbols that a task adds up before it hands them on.
PAIRS_AT_ONCE = 1 << 21
SPLIT_SEED = 2998


def chat_format(pairs: DataFrame, caption: str = "caption", svg: str = "svg", infer: bool = False) -> DataFrame:
    head = F.concat(F.lit(f"{IM_START}system\n{SYSTEM_TEXT}{IM_END}\n{IM_START}user\n{USER_TEXT}"), F.col(caption),
                    F.lit(f"{IM_END}\n{IM_START}assistant\n"))
    text = F.concat(head, F.lit("")) if infer else F.concat(head, F.col(svg), F.lit(IM_END))
    return pairs.withColumn("text", text)


def conversation_pack(conv: DataFrame) -> DataFrame:
    """Turns -> one templated string per conversation (turn order; one collect per conversation)."""
    piece = F.concat(F.lit(IM_START), F.col("role"), F.lit("\n"), F.col("text"), F.lit(IM_END))
    g = conv.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", piece.alias("p")))).alias("_t"))
    return g.select("conv_id", F.array_join(F.transform("_t", lambda x: x["p"]), "\n").alias("text"),
                    F.size("_t").alias("n_turns"))


def response_spans(df: DataFrame, text: str = "text") -> DataFrame:
    """Assistant spans ``[start, end)`` in characters: from after each response marker to the next instruction marker
    (or the end); ``spans`` is an array of structs, with their number and total length beside it."""
    parts = F.split(F.col(text), F.lit(RESPONSE_MARK.replace("|", "\\|")))
    kept = lambda p: F.length(F.substring_index(p, INSTRUCTION_MARK, 1))
    start = F.struct(F.lit(-len(RESPONSE_MARK)).alias("pos"), F.array().cast("array<struct<start:int,end:int>>").alias("out"))

    def step(st, p):
        at = st["pos"] + F.lit(len(RESPONSE_MARK))
        return F.struct((at + F.length(p)).alias("pos"), F.array_append(st["out"], F.struct(at.alias("start"), (at + kept(p)).alias("end"))).alias("out"))

    df = df.withColumn("spans", F.aggregate(parts, start, step, lambda st: F.slice(st["out"], 2, 1 << 30)))
    total = F.aggregate("spans", F.lit(0), lambda a, s: a + s["end"] - s["start"])
    return df.withColumn("n_spans", F.size("spans")).withColumn("response_chars", total)


def split_rows(df: DataFrame, key: str, val_fraction: float = 0.05, seed: int = SPLIT_SEED) -> DataFrame:
    """train / val by an md5 bucket of the content key, so duplicates never straddle the split."""
    return df.withColumn("split", F.when(uniform01(F.lit(seed), F.col(key)) < val_fraction, "val").otherwise("train"))


def special_token_counts(docs: DataFrame, text: str = "svg") -> DataFrame:
    """Occurrences of every special token over the corpus, tokens without any included.

    One pass cuts the text into units: a tag's opening with its name (and ``>`` if it follows at once), a closing
    tag, a namespace URL, or a name. A name counts as an attribute or transform where ``=`` or ``(`` follows, so
    ``<line`` is not part of ``<linearGradient`` nor ``translate`` of other words."""
    units = docs.select(F.explode(F.regexp_extract_all(F.col(text), F.lit(SPECIAL_UNIT_RE), 0)).alias("u"))
    token = F.regexp_replace("u", r"\s*[=(]$", "")
    listed = docs.sparkSession.createDataFrame([(t,) for t in dict.fromkeys(SPECIAL_TOKENS)], "token string")
    counts = units.select(token.alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    return listed.join(counts, "token", "left").select("token", F.coalesce("n", F.lit(0)).cast("bigint").alias("n"))


def pretokens(docs: DataFrame, text: str = "text", key: str = "doc_id", pattern: str = PRETOKEN_RE) -> DataFrame:
    return docs.select(key, F.posexplode(F.regexp_extract_all(F.col(text), F.lit(pattern), 0)).alias("pos", "word"))


def runs(docs: DataFrame, text: str = "text", *keys: str) -> DataFrame:
    """One row per stretch without white space: ``(*keys, run)``. Pre-tokens neither hold white space nor look past it, so
    those of a text are those of its runs, and the pattern needs to take apart each distinct run only."""
    return docs.select(*keys, F.explode(F.split(F.col(text), r"\s+")).alias("run")).where(F.col("run") != "")


def pretoken_counts(docs: DataFrame, text: str = "text", min_frequency: int = MIN_FREQUENCY, pattern: str = PRETOKEN_RE) -> DataFrame:
    counted = runs(docs, text).groupBy("run").agg(F.count(F.lit(1)).alias("n"))
    words = counted.select(F.explode(F.regexp_extract_all("run", F.lit(pattern), 0)).alias("word"), "n")
    return words.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_frequency)


def unit_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """The words to learn merges from: special tokens stay whole, so they take no part."""
    return pretoken_counts(docs, text, pattern=UNIT_RE).where(~F.col("word").isin(SPECIAL_TOKENS))


def bpe_apply(symbols: list[str], ranks: dict[tuple[str, str], int]) -> list[str]:
    """Merges the pair of the lowest rank, all of it from the left, until no learned pair is left.

    A heap holds the learned pairs by rank and place, so a word of n symbols takes n log n steps, however long it is."""
    n = len(symbols)
    symbols, after, before = list(symbols), list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [(ranks[p], i) for i, p in enumerate(zip(symbols, symbols[1:])) if p in ranks]
    heapify(heap)
    while heap:
        rank, made = heap[0][0], []
        while heap and heap[0][0] == rank:
            i = heappop(heap)[1]
            j = after[i]
            # a place whose pair is another by now has been merged from the left
            if j == n or symbols[i] is None or ranks.get((symbols[i], symbols[j])) != rank:
                continue
            symbols[i], symbols[j], after[i] = symbols[i] + symbols[j], None, after[j]
            if after[i] < n:
                before[after[i]] = i
            made.append(i)
        for k in {m for i in made for m in (before[i], i) if m >= 0}:
            j = after[k]
            if j < n and symbols[k] is not None and (symbols[k], symbols[j]) in ranks:
                heappush(heap, (ranks[symbols[k], symbols[j]], k))
    return [s for s in symbols if s is not None]


class Merges:
    """The merges learned so far, of numbered tokens."""

    def __init__(self, merges: list[tuple[str, str]] = ()):
        """``merges`` by rank; of a pair that repeats, the first counts."""
        self.tokens: list[str] = []
        self.numbers: dict[str, int] = {}
        self.pairs: dict[int, int] = {}  # the token that a pair makes, by rank
        for a, b in merges:
            self.add(a, b)

    def add(self, a: str, b: str) -> None:
        x, y, made = (self._number(t) for t in (a, b, a + b))
        self.pairs.setdefault(x << 32 | y, made)

    def _number(self, token: str) -> int:
        if len(token) == 1:
            return ord(token)
        if token not in self.numbers:
            self.numbers[token] = FIRST_TOKEN + len(self.tokens)
            self.tokens.append(token)
        return self.numbers[token]

    def table(self) -> MergeTable:
        return MergeTable(np.fromiter(self.pairs, np.int64, len(self.pairs)), np.fromiter(self.pairs.values(), np.int32, len(self.pairs)), list(self.tokens))


class MergeTable:
    """What tasks get of the merges: words as arrays of numbers are merged together."""

    def __init__(self, pairs: np.ndarray, made: np.ndarray, tokens: list[str]):
        order = np.argsort(pairs)
        self.keys, self.ranks, self.made, self.tokens = pairs[order], order.astype(np.int32), made[order], tokens

    def names(self, numbers: np.ndarray) -> list[str]:
        return [chr(i) if i < FIRST_TOKEN else self.tokens[i - FIRST_TOKEN] for i in numbers.tolist()]

    def apply(self, sym: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """As ``bpe_apply`` for each word: ``sym`` are the symbols of all words, ``word`` the word of each, whose symbols lie
        together. Words come back in another order."""
        if not len(self.keys) or not len(sym):
            return sym, word
        done = []
        length = np.bincount(word)
        if length.max() > LONG_WORD:
            ranks = dict(zip(zip(self.names(self.keys >> 32), self.names(self.keys & 0xFFFFFFFF)), self.ranks.tolist()))
            numbers = {t: FIRST_TOKEN + i for i, t in enumerate(self.tokens)}
            for w in np.flatnonzero(length > LONG_WORD):
                merged = np.array([numbers[t] if len(t) > 1 else ord(t) for t in bpe_apply(self.names(sym[word == w]), ranks)], np.int32)
                done.append((merged, np.full(len(merged), w)))
            short = length[word] <= LONG_WORD
            sym, word = sym[short], word[short]
        while len(sym) > 1:
            pair = sym[:-1].astype(np.int64) << 32 | sym[1:]
            at = np.minimum(np.searchsorted(self.keys, pair), len(self.keys) - 1)
            hits = np.flatnonzero((self.keys[at] == pair) & (word[:-1] == word[1:]))
            if not len(hits):
                break
            # the lowest rank of each word, everywhere in it from the left
            owner, rank = word[hits], self.ranks[at[hits]]
            first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            lowest = np.repeat(np.minimum.reduceat(rank, first), np.diff(np.r_[first, len(hits)]))
            took = hits[rank == lowest]
            # places side by side overlap (a symbol doubled): every second one counts
            start = np.r_[True, np.diff(took) != 1]
            place = np.arange(len(took))
            took = took[(place - place[start][np.cumsum(start) - 1]) % 2 == 0]
            sym = sym.copy()
            sym[took] = self.made[at[took]]
            keep = np.ones(len(sym), bool)
            keep[took + 1] = False
            active = np.zeros(int(word.max()) + 1, bool)
            active[owner] = True
            more = active[word]
            done.append((sym[keep & ~more], word[keep & ~more]))
            sym, word = sym[keep & more], word[keep & more]
        done.append((sym, word))
        return np.concatenate([x for x, _ in done]), np.concatenate([w for _, w in done])


def _characters(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of words, and the word of each."""
    return (np.frombuffer("".join(words).encode("utf-32-le"), np.int32),
            np.repeat(np.arange(len(words)), np.fromiter(map(len, words), np.int64, len(words))))


def _listed(sym: np.ndarray, word: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    """(sym, n) of the words with more than one symbol; those of one are done."""
    first = np.flatnonzero(np.r_[True, word[1:] != word[:-1]]) if len(word) else np.zeros(0, np.int64)
    length = np.diff(np.r_[first, len(word)])
    kept = length > 1
    offsets = np.r_[0, np.cumsum(length[kept])].astype(np.int32)
    sym = sym[np.repeat(kept, length)]
    return pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(pa.array(offsets), pa.array(sym, pa.int32())), pa.array(n[word[first[kept]]], pa.int64())], names=["sym", "n"])


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(sym, n) of (word, n): the characters as numbers."""
    for batch in batches:
        yield _listed(*_characters(batch.column(0).to_pylist()), batch.column(1).to_numpy())


def _merged(batch: pa.RecordBatch, table: MergeTable) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(sym, word, n) of a batch of (sym, n) after the merges."""
    sym = batch.column(0)
    word = np.repeat(np.arange(len(sym)), np.diff(sym.offsets.to_numpy()))
    return *table.apply(sym.flatten().to_numpy(), word), batch.column(1).to_numpy()


def _rewritten(table: MergeTable) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(sym, n) after the merges."""
    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield _listed(*_merged(batch, table))

    return rewrite


def _added_up(pairs: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(pairs, kind="stable")
    pairs, n = pairs[order], n[order]
    first = np.flatnonzero(np.r_[True, pairs[1:] != pairs[:-1]]) if len(pairs) else np.zeros(0, np.int64)
    return pairs[first], np.add.reduceat(n, first) if len(first) else n


def _pair_counts(table: MergeTable) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(pair, n): the adjacent pairs after the merges, as two numbers in one, added up."""
    def rows(held: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        pairs, n = _added_up(*(np.concatenate(x) for x in zip(*held)))
        return pa.RecordBatch.from_arrays([pa.array(pairs, pa.int64()), pa.array(n, pa.int64())], names=["pair", "n"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            sym, word, n = _merged(batch, table)
            at = np.flatnonzero(word[:-1] == word[1:])
            held.append(_added_up(sym[at].astype(np.int64) << 32 | sym[at + 1], n[word[at]]))
            size += len(held[-1][0])
            if size >= PAIRS_AT_ONCE:
                yield rows(held)
                held, size = [], 0
        if held:
            yield rows(held)

    return count


def _named(table: MergeTable) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(a, b, cnt) of (pair, cnt), without pairs that have less than ``ROUND_SHARE`` of a count seen before: no round takes them."""
    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        most = 0
        for batch in batches:
            pair, cnt = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            most = max(most, cnt.max(initial=0))
            kept = cnt >= ROUND_SHARE * most
            pair, cnt = pair[kept], cnt[kept]
            yield pa.RecordBatch.from_arrays([pa.array(table.names(pair >> 32), pa.string()), pa.array(table.names(pair & 0xFFFFFFFF), pa.string()), pa.array(cnt, pa.int64())],
                                             names=["a", "b", "cnt"])

    return name


def bpe_merges(spark: SparkSession, word_counts: DataFrame, n_merges: int, merges_per_round: int = 1, known=(), checkpoint_every: int = 10):
    """Learn merges until they have made ``n_merges`` tokens that are not ``known``, or no pair is left.

    Each round counts adjacent symbol pairs weighted by word frequency over the distinct words. Of the first
    ``merges_per_round`` pairs (count desc, pair asc) it takes those that cannot overlap a pair taken before (no
    symbol ends one and begins another) and have ``ROUND_SHARE`` of the largest count; 1 is the exact
    mode. The driver holds the merges and a round's pairs only; the words are rewritten at a ``checkpoint()``
    (reliable, under spark.checkpoint.dir)."""
    words = word_counts.select("word", F.col("n").cast("bigint").alias("n")).mapInArrow(_numbered, "sym array<int>, n bigint")
    words = words.checkpoint()  # the corpus is read once, not in every round
    merges, learned, known, room, r = [], Merges(), set(known), n_merges, 0
    while room > 0:
        table = learned.table()
        pairs = words.mapInArrow(_pair_counts(table), "pair bigint, n bigint").groupBy("pair").agg(F.sum("n").alias("cnt"))
        best = (pairs.mapInArrow(_named(table), "a string, b string, cnt bigint")
                .orderBy(F.desc("cnt"), F.col("a"), F.col("b")).limit(merges_per_round))
        # of these rows, one task's, the driver gets those that the round may take
        best = best.withColumn("most", F.max("cnt").over(Window.partitionBy(F.lit(0)))).where(F.col("cnt") >= ROUND_SHARE * F.col("most"))
        best = sorted(((r["a"], r["b"], r["cnt"]) for r in best.select("a", "b", "cnt").collect()), key=lambda r: (-r[2], r[0], r[1]))
        if not best:
            break
        begins, ends = set(), set()
        for a, b, cnt in best:
            if room <= 0:
                break
            if a in ends or b in begins:
                continue
            begins.add(a)
            ends.add(b)
            merges.append((len(merges), a, b, int(cnt)))
            learned.add(a, b)
            room -= a + b not in known
            known.add(a + b)
        r += 1
        if r % checkpoint_every == 0:
            words = words.mapInArrow(_rewritten(learned.table()), "sym array<int>, n bigint").checkpoint()
    return spark.createDataFrame(merges, "rank int, a string, b string, cnt bigint")


def vocab_table(spark: SparkSession, merges: DataFrame, alphabet: DataFrame, extra: DataFrame | None = None) -> DataFrame:
    """Ids: base specials, new specials, alphabet, then learned merges by rank (bounded by the vocabulary size), then the
    tokens of ``extra`` (rank, token), such as those of an older vocabulary, that are not among them."""
    fixed = spark.createDataFrame([(0, i, t) for i, t in enumerate(BASE_SPECIALS)] +
                                  [(1, i, t) for i, t in enumerate(SPECIAL_TOKENS)], "cls int, rank int, token string")
    alpha = alphabet.select(F.lit(2).alias("cls"), F.lit(0).alias("rank"), F.col("token"))
    learned = merges.select(F.lit(3).alias("cls"), F.col("rank"), F.concat("a", "b").alias("token"))
    allv = fixed.unionByName(alpha).unionByName(learned)
    if extra is not None:
        allv = allv.unionByName(extra.select(F.lit(4).alias("cls"), F.col("rank").cast("int").alias("rank"), "token"))
    first = allv.groupBy("token").agg(F.min(F.struct("cls", "rank")).alias("k"))
    return first.select("token", F.col("k.cls").alias("cls"), F.col("k.rank").alias("rank")) \
        .withColumn("id", (F.row_number().over(Window.orderBy("cls", "rank", "token")) - 1).cast("bigint"))


def encode_words(words: DataFrame, merges: list[tuple[str, str]]) -> DataFrame:
    """Distinct words -> token arrays by the learned merges, lowest rank first; a special token is one token."""
    table, whole = Merges(merges).table(), frozenset(SPECIAL_TOKENS)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = batch.column(0).to_pylist()
            special, plain, empty = [w for w in got if w in whole], [w for w in got if w and w not in whole], [w for w in got if w == ""]
            sym, word = table.apply(*_characters(plain))
            first = np.flatnonzero(np.r_[True, word[1:] != word[:-1]]) if len(word) else np.zeros(0, np.int64)
            offsets = np.r_[first, len(sym) + np.arange(len(special) + 1), np.full(len(empty), len(sym) + len(special))].astype(np.int32)
            tokens = pa.ListArray.from_arrays(pa.array(offsets), pa.array(table.names(sym) + special, pa.string()))
            yield pa.RecordBatch.from_arrays([pa.array([plain[i] for i in word[first].tolist()] + special + empty, pa.string()), tokens], names=["word", "tokens"])

    return words.select("word").mapInArrow(encode, "word string, tokens array<string>")


def truncate_seq(lengths: DataFrame, max_len: int) -> DataFrame:
    return lengths.withColumn("n_kept", F.least(F.col("n_tok"), F.lit(max_len)).cast("bigint")) \
        .withColumn("truncated", F.col("n_tok") > max_len)


def stage_assign(lengths: DataFrame) -> DataFrame:
    return lengths.withColumn("stage", F.when(F.col("n_tok") <= 1024, "stage1").when(F.col("n_tok") <= 8192, "stage2").otherwise("stage3"))


def mlm_select(lengths: DataFrame, p: float, seed: int, key: str = "doc_id") -> DataFrame:
    """Number of masked positions per document: position i is chosen when md5(seed|doc|i) < p."""
    pos = F.when(F.col("n_tok") > 0, F.sequence(F.lit(0), F.col("n_tok").cast("int") - 1)).otherwise(F.array().cast("array<int>"))
    chosen = F.filter(pos, lambda i: uniform01(F.lit(seed), F.col(key), i) < p)
    return lengths.withColumn("n_masked", F.size(chosen).cast("bigint"))


def _cumulative(df: DataFrame, order_col: str, tie_col: str, val: str, out: str, bucket_chars: int = 3) -> DataFrame:
    """Exact running sum of ``val`` in (order_col, tie_col) order: per-bucket totals (tiny window)
    plus a within-bucket window; order_col is a hex digest."""
    b = df.withColumn("_bucket", F.substring(F.col(order_col), 1, bucket_chars))
    w = Window.partitionBy("_bucket").orderBy(order_col, tie_col).rowsBetween(Window.unboundedPreceding, 0)
    inner = b.withColumn("_in", F.sum(val).over(w))
    tot = b.groupBy("_bucket").agg(F.sum(val).alias("_t"))
    off = tot.withColumn("_off", F.coalesce(F.sum("_t").over(Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    return inner.join(F.broadcast(off.select("_bucket", "_off")), "_bucket").withColumn(out, (F.col("_off") + F.col("_in")).cast("bigint")) \
        .drop("_bucket", "_in", "_off")


def token_budget(lengths: DataFrame, budget: int, seed: int, key: str = "doc_id") -> DataFrame:
    """Documents taken in shuffled order until ``budget`` tokens are reached (the one crossing it included)."""
    d = S.seeded_shuffle(lengths, seed, key)
    c = _cumulative(d, "shuffle_key", key, "n_tok", "cum_tok")
    return c.where(F.col("cum_tok") - F.col("n_tok") < budget)


def pack_sequences(lengths: DataFrame, max_len: int, seed: int, key: str = "doc_id", group: int = 256) -> DataFrame:
    """Next-fit packing in shuffled order, inside consecutive groups of ``group`` documents (each
    group is one bounded array fold). Returns ``(group_id, bin, key, n_tok)`` with n_tok capped."""
    d = S.global_rank(S.seeded_shuffle(lengths, seed, key), "shuffle_key", key, "_rn")
    d = d.withColumn("group_id", F.floor((F.col("_rn") - 1) / group).cast("bigint")).withColumn("_len", F.least("n_tok", F.lit(max_len)))
    g = d.groupBy("group_id").agg(F.array_sort(F.collect_list(F.struct("_rn", F.col(key).alias("k"), "_len"))).alias("_docs"))
    st0 = F.struct(F.lit(0).alias("bin"), F.lit(0).cast("bigint").alias("used"),
                   F.array().cast(f"array<struct<bin:int,k:bigint,len:bigint>>").alias("out"))

    def step(st, x):
        new_bin = (st["used"] + x["_len"] > max_len) & (st["used"] > 0)
        b = F.when(new_bin, st["bin"] + 1).otherwise(st["bin"])
        used = F.when(new_bin, x["_len"]).otherwise(st["used"] + x["_len"])
        return F.struct(b.alias("bin"), used.cast("bigint").alias("used"),
                        F.array_append(st["out"], F.struct(b.alias("bin"), x["k"].cast("bigint").alias("k"), x["_len"].cast("bigint").alias("len"))).alias("out"))

    packed = g.select("group_id", F.explode(F.aggregate("_docs", st0, step, lambda s: s["out"])).alias("p"))
    return packed.select("group_id", F.col("p.bin").alias("bin"), F.col("p.k").alias(key), F.col("p.len").alias("n_tok"))


def packing_efficiency(packed: DataFrame, max_len: int) -> DataFrame:
    bins = packed.groupBy("group_id", "bin").agg(F.sum("n_tok").alias("used"))
    return bins.agg(F.count(F.lit(1)).alias("n_bins"), F.sum("used").cast("bigint").alias("used_tokens"),
                    F.round(F.sum("used") / (F.count(F.lit(1)) * max_len), 6).alias("efficiency"))


def root_mode(seed: int, hash_col: str = "hash", root_prob: float = 0.10) -> F.Column:
    """Whether a record gets a root fill: true with probability root_prob."""
    return uniform01(F.lit(seed), F.col(hash_col), F.lit("root")) < root_prob


def augment_fill(el: DataFrame, seed: int, hash_col: str = "hash") -> DataFrame:
    """New ``fill`` per element: where ``root_mode`` is true a random root fill (other fills removed),
    else a random fill on every path. Colours are 6 hex digits of md5(seed|hash|slot). The elements have the ``root_mode``
    and the hash of their record, which are told once a record."""
    root_mode = F.col("root_mode")
    colour = lambda slot: F.concat(F.lit("#"), F.upper(F.substring(F.md5(F.concat_ws("|", F.lit(str(seed)), F.col(hash_col), slot.cast("string"))), 1, 6)))
    is_root = F.col("depth") == 0
    fill = (F.when(root_mode & is_root, colour(F.lit("rootfill")))
            .when(root_mode, F.lit(None))
            .when(F.col("tag") == "path", colour(F.col("open_pos")))
            .otherwise(F.col("lattrs")["fill"]))
    return el.withColumn("new_fill", fill)


def augmented_svg(hashed: DataFrame, tokens: DataFrame, seed: int, key: str = "rec_id") -> DataFrame:
    """Markup with the fills of ``augment_fill``: ``(key, svg_out)`` for the tokens of well-formed records; those of ``hashed``
    have the ``hash`` and ``root_mode`` of their record too."""
    el = augment_fill(T.lower_attrs(T.svg_elements(hashed, key, ("hash", "root_mode"))), seed)
    other = F.map_filter("attrs", lambda k, v: F.lower(k) != "fill")
    there = F.map_contains_key("lattrs", F.lit("fill"))
    filled = F.transform_values("attrs", lambda k, v: F.when(F.lower(k) == "fill", F.col("new_fill")).otherwise(v))
    attrs = (F.when(F.col("new_fill").isNull(), other).when(there, filled)
             .otherwise(F.map_concat("attrs", F.create_map(F.lit("fill"), F.col("new_fill")))))
    return svg_text(tokens, el.select(key, "open_pos", "close_pos", F.col("qname").alias("new_tag"), attrs.alias("new_attrs")), key)


def optimized_pairs(lineage: DataFrame, seed: int, key: str = "rec_id") -> DataFrame:
    """Positive pairs (raw, stage2) labelled 1; negatives pair each raw with the stage2 of the next record in
    md5 order (a rank shift; the last record takes the first one's), labelled 0 unless it is the same stage2."""
    ok = lineage.where(F.col("stage2").isNotNull()).select(key, "raw", "stage2")
    r = S.global_rank(S.seeded_shuffle(ok, seed, key), "shuffle_key", key, "rn")
    last = r.agg(F.max("rn").alias("last"))  # one row
    nxt = r.join(F.broadcast(last)).select(F.when(F.col("rn") == 1, F.col("last")).otherwise(F.col("rn") - 1).alias("rn_prev"), F.col("stage2").alias("other"))
    pos = r.select(key, F.col("raw").alias("a"), F.col("stage2").alias("b"), F.lit(1).alias("label"))
    neg = (r.join(nxt, (F.col("rn") == F.col("rn_prev")) & (F.col("stage2") != F.col("other")))
           .select(key, F.col("raw").alias("a"), F.col("other").alias("b"), F.lit(0).alias("label")))
    return pos.unionByName(neg)
