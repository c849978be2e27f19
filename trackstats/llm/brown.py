"""Language-model scores from Brown classes.

Exchange clustering puts every training word into one of ``CLASSES`` classes so
that bigrams of classes become as likely as possible: a word moves to the class
in which the sum of n log n over the class bigrams, less that over the classes on
both sides, grows most, its own bigrams taken out of its present class. Half of
the words may move in a round; a round that would make the corpus less likely is
taken back and fewer words move at once from then on, so the likelihood never falls.

The ``COMMON`` words counted most often have names of their own as neighbours;
their classes, a byte each, are all that travels between rounds. The bigrams of
words with such neighbours are counted once and stay distributed. Rarer words, of
which there may be any number, are one kind of neighbour, END is another; a rarer
word joins the class that its neighbours make likeliest. The model is
P(word | before) = P(class | class before) P(word | class); absolute discounting
of the words of a class leaves room for unseen words.

Words are 64-bit hashes throughout. To look up the words of a text, texts are
dealt into blocks, each block asks the word table for its distinct words, and
the answers meet the block's texts.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import words as W
from .registry import query, table
from .store import stored
from .tables import PARTS, parts, summed

CLASSES, ROUNDS = 64, 8
#: Words that are neighbours in their own name; their hashes take 8 MB and their classes 1 MB.
COMMON = 1 << 20
DISCOUNT, SMOOTHING = 0.75, 50.0
#: Tokens that a counting task sums up before it sends them on; bytes of text in a block; words in a shard.
FLUSH, BLOCK, SHARD = 1 << 20, 32 << 20, 1 << 17
#: Words whose neighbours are counted by class, and entries whose gains are worked out, at a time.
STEP, ENTRIES = 1 << 15, 1 << 15
#: Class numbers of the end of a text and of unseen words; among neighbours the second is that of rarer words.
_END_CLASS, _UNSEEN = CLASSES, CLASSES + 1
_RARE = _UNSEEN
_STATES = CLASSES + 2
#: Neighbour numbers of END and of rarer words; those of the words behind come after all those before.
_END_ID, _RARE_ID, _SIDE = COMMON, COMMON + 1, COMMON + 2
END = W.mix(np.array([0xE0D], W.U64))[0]


def _tokens(chunk: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Token hashes of some texts, each closed by the end token, and the number of tokens of each."""
    w = W.Words(chunk)
    seq = np.full(len(w.start) + len(chunk), END, W.U64)
    seq[np.arange(len(w.start)) + w.text_of()] = w.hashes()
    return seq, w.count + 1


def _sparse(rows: np.ndarray, codes: np.ndarray, n_rows: int, weights: np.ndarray | None = None):
    """Sums by (row, code), in order, and where each row begins."""
    key, inverse = np.unique(rows * (2 * _SIDE) + codes, return_inverse=True)
    total = np.bincount(inverse, weights, len(key)).astype(np.int64)
    begin = np.searchsorted(key, np.arange(n_rows + 1) * (2 * _SIDE))
    return key % (2 * _SIDE), total, begin


#: Words travel in groups by the first bits of their hashes, packed.
GROUP_BITS = 12
_GROUP_STARTS = np.arange(1 << GROUP_BITS, dtype=W.U64) << W.U64(64 - GROUP_BITS)
PACKED = "word_group int, words binary, n binary, lengths binary, codes binary, counts binary"
COUNTED = "word long, n long, codes array<int>, counts array<int>"


def _word_batches(h, n, codes, counts, begin, size: int = 1 << 15):
    for at in range(0, len(h), size):
        stop = min(at + size, len(h))
        a, b = begin[at], begin[stop]
        ends = pa.array(begin[at:stop + 1] - a, pa.int32())
        yield pa.RecordBatch.from_arrays([
            pa.array(W.signed(h[at:stop])), pa.array(n[at:stop], pa.int64()),
            pa.ListArray.from_arrays(ends, pa.array(codes[a:b], pa.int32())),
            pa.ListArray.from_arrays(ends, pa.array(counts[a:b], pa.int32()))], names=["word", "n", "codes", "counts"])


def _flushed(batches, flush):
    held, size = [], 0
    for batch in batches:
        for _, chunk in W.text_chunks(batch.column(0).to_pylist()):
            seq, _ = _tokens(chunk)
            held.append(seq)
            size += len(seq)
            if size >= FLUSH:
                yield from flush(np.concatenate(held))
                held, size = [], 0
    if held:
        yield from flush(np.concatenate(held))


def _tally(batches):
    """Words that occur at least twice among ``FLUSH`` tokens of a task: no other is common."""
    def flush(seq):
        h, n = np.unique(seq, return_counts=True)
        often = (n > 1) & (h != END)
        yield pa.RecordBatch.from_arrays([pa.array(W.signed(h[often])), pa.array(n[often])], names=["word", "n"])
    return _flushed(batches, flush)


def common_words(texts: DataFrame) -> np.ndarray:
    """Hashes, in order, of at most ``COMMON`` words that were counted most often; words counted alike are in or out together."""
    counts = stored(texts.mapInArrow(_tally, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")), "tallies")
    left, least = COMMON, None
    for r in sorted(counts.groupBy("n").agg(F.count(F.lit(1)).alias("words")).collect(), key=lambda r: -r.n):  # one row per count
        left -= r.words
        if left < 0:
            break
        least = r.n
    if least is None:
        return np.zeros(0, W.U64)
    found = counts.where(F.col("n") >= least).select("word").toArrow()
    return np.sort(found.column("word").to_numpy().view(W.U64))


def _ids(common: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Neighbour numbers of words."""
    at = np.minimum(np.searchsorted(common, h), max(len(common) - 1, 0))
    known = common[at] == h if len(common) else np.zeros(len(h), bool)
    return np.where(h == END, _END_ID, np.where(known, at, _RARE_ID))


def _count(common):
    """Each task's words with their counts and neighbours, every ``FLUSH`` tokens."""
    def flush(seq):
        h, place, n = np.unique(seq, return_inverse=True, return_counts=True)
        ids = _ids(common.value, h)[place]
        before = np.concatenate([[_END_ID], ids[:-1]])
        after = np.where(seq == END, _END_ID, np.concatenate([ids[1:], [_END_ID]]))
        codes, counts, begin = _sparse(np.concatenate([place, place]), np.concatenate([before, after + _SIDE]), len(h))
        first = np.append(np.searchsorted(h, _GROUP_STARTS), len(h))
        rows = []
        for g in np.flatnonzero(np.diff(first)).tolist():
            a, b = first[g], first[g + 1]
            part = slice(begin[a], begin[b])
            rows.append((g, h[a:b].tobytes(), n[a:b].astype(np.int64).tobytes(), np.diff(begin[a:b + 1]).astype(np.int32).tobytes(),
                         codes[part].astype(np.int32).tobytes(), counts[part].astype(np.int32).tobytes()))
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int32(), *[pa.binary()] * 5))],
                                         names=[c.split()[0] for c in PACKED.split(", ")])
    return lambda batches: _flushed(batches, flush)


def _columns(table_: pa.Table | pa.RecordBatch):
    """Words, counts, row of each neighbour entry, its code and count."""
    codes = table_.column(2)
    codes = codes.combine_chunks() if isinstance(codes, pa.ChunkedArray) else codes
    counts = table_.column(3)
    counts = counts.combine_chunks() if isinstance(counts, pa.ChunkedArray) else counts
    length = codes.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    return (table_.column(0).to_numpy().view(W.U64), table_.column(1).to_numpy(), length,
            codes.flatten().to_numpy().astype(np.int64), counts.flatten().to_numpy().astype(np.int64))


def _merge(batches):
    """One row per word; a task holds the words of its shuffle partition."""
    got = [b for b in batches if b.num_rows]
    if not got:
        return
    joined = [b"".join(x for b in got for x in b.column(i).to_pylist()) for i in range(1, 6)]
    h, n, length, codes, counts = (np.frombuffer(x, t) for x, t in zip(joined, (W.U64, np.int64, np.int32, np.int32, np.int32), strict=True))
    codes = codes.astype(np.int64)
    words, inverse = np.unique(h, return_inverse=True)
    total = np.bincount(inverse, n, len(words)).astype(np.int64)
    codes, counts, begin = _sparse(np.repeat(inverse, length), codes, len(words), counts)
    yield from _word_batches(words, total, codes, counts, begin)


def _first_classes(length: np.ndarray, codes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """By the most frequent neighbour."""
    begin = np.cumsum(length) - length
    most = np.maximum.reduceat(counts * (2 * _SIDE) + codes, begin) % (2 * _SIDE)
    return (W.mix(most.astype(W.U64)) % W.U64(CLASSES)).astype(np.uint8)


def _by_class(classes: np.ndarray, length, codes, counts) -> np.ndarray:
    """Neighbours of each word by their class: words, side, class."""
    of = np.concatenate([classes, np.full(COMMON - len(classes), _RARE, np.uint8), [_END_CLASS, _RARE]]).astype(np.int64)
    code = of[codes % _SIDE] + np.where(codes >= _SIDE, _STATES, 0)
    rows = np.repeat(np.arange(len(length)), length)
    return np.bincount(rows * (2 * _STATES) + code, counts, len(length) * 2 * _STATES).reshape(-1, 2, _STATES)


def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1.0))


def likelihood(bigrams: np.ndarray) -> float:
    """What of the corpus's log likelihood depends on the classes."""
    return float(_xlogx(bigrams).sum() - _xlogx(bigrams.sum(0)).sum() - _xlogx(bigrams.sum(1)).sum())


def gains(near: np.ndarray, n: np.ndarray, own: np.ndarray, twice: np.ndarray, bigrams: np.ndarray) -> np.ndarray:
    """By how much the likelihood grows when each word is put into each class, after it was taken out of its ``own``.

    ``near`` are its neighbours by side and class, ``n`` its count, ``twice`` how
    often it follows itself (counted in its own class on both sides).
    """
    rows = np.arange(len(n))
    near = near.astype(float)
    near[rows, 0, own] -= twice
    near[rows, 1, own] -= twice
    sizes = bigrams.sum(0)[:CLASSES]
    gain = np.zeros((len(n), CLASSES))
    for side in (0, 1):
        table_ = bigrams if side == 0 else bigrams.T  # neighbour's class, word's class
        other = near[:, 1 - side, :CLASSES]
        row, g = np.nonzero(near[:, side])
        for at in range(0, len(row), ENTRIES):
            r, c = row[at:at + ENTRIES], g[at:at + ENTRIES]
            with_ = near[r, side, c]
            base = table_[c, :CLASSES].copy()
            mine = np.flatnonzero(c == own[r])  # neighbours in the word's own class: bigrams with the word go
            base[mine] -= other[r[mine]]
            base[np.arange(len(r)), own[r]] = table_[c, own[r]] - with_
            base[mine, own[r[mine]]] = 0  # both ends in the class the word leaves: below
            grown = _xlogx(base + with_[:, None]) - _xlogx(base)
            inside = np.flatnonzero(c < CLASSES)
            grown[inside, c[inside]] = 0
            first = np.flatnonzero(np.diff(r, prepend=-1))
            gain[r[first]] += np.add.reduceat(grown, first)
    both = near[:, 0, :CLASSES] + near[:, 1, :CLASSES] + twice[:, None]
    corner = np.broadcast_to(np.diag(bigrams)[:CLASSES], both.shape).copy()
    left = np.broadcast_to(sizes, both.shape).copy()
    corner[rows, own] -= both[rows, own]
    left[rows, own] -= n
    gain += _xlogx(corner + both) - _xlogx(corner)
    return gain - 2 * (_xlogx(left + n[:, None]) - _xlogx(left))


def likeliest(near: np.ndarray, bigrams: np.ndarray, alpha: float = 0.05) -> np.ndarray:
    """The class under which the neighbours of each word, by side and class, are likeliest."""
    sides = [x / x.sum(0) for x in (bigrams[:, :CLASSES] + alpha, bigrams[:CLASSES].T + alpha)]
    return sum(near[:, side] @ np.log(share) for side, share in enumerate(sides)).argmax(1)


def _tables(batches, common: np.ndarray, classes: np.ndarray):
    """Words of the table in steps: hash, number among the common ones, count, neighbours by class, how often a word follows itself."""
    for t in _gathered(batches):
        h, n, length, codes, counts = _columns(t)
        begin = np.concatenate([[0], np.cumsum(length)])
        ids = _ids(common, h)
        for at in range(0, len(h), STEP):
            stop = min(at + STEP, len(h))
            part = slice(begin[at], begin[stop])
            near = _by_class(classes, length[at:stop], codes[part], counts[part])
            owner = np.repeat(np.arange(stop - at), length[at:stop])
            same = codes[part] == ids[at:stop][owner]
            twice = np.bincount(owner[same], counts[part][same], stop - at)
            yield h[at:stop], ids[at:stop], n[at:stop], near, np.where(ids[at:stop] < COMMON, twice, 0)


def _gathered(batches, size: int = 1 << 16):
    """Rows in tables of about ``size``."""
    held, rows = [], 0
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            rows += batch.num_rows
        if rows >= size:
            yield pa.Table.from_batches(held)
            held, rows = [], 0
    if held:
        yield pa.Table.from_batches(held)


def _collected(made: DataFrame, size: int) -> np.ndarray:
    """Classes by word number from packed rows ``ids, classes``: a byte for each common word."""
    out = np.full(size, _RARE, np.uint8)
    for r in made.collect():  # five bytes a common word
        out[np.frombuffer(r.ids, np.int32)] = np.frombuffer(r.classes, np.uint8)
    return out


_MOVED = "ids binary, classes binary"


def _moved(ids: np.ndarray, classes: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([ids.astype(np.int32).tobytes()]), pa.array([classes.astype(np.uint8).tobytes()])], names=["ids", "classes"])


def class_bigrams(counted: DataFrame, common, classes: np.ndarray) -> np.ndarray:
    """Bigrams by the classes of both words, those of two rarer words or of END with one left out: they never change."""
    shared = counted.sparkSession.sparkContext.broadcast(classes)

    def add(batches):
        total = np.zeros((_STATES, _STATES))
        for _, ids, _, near, _ in _tables(batches, common.value, shared.value):
            own = shared.value[ids].astype(np.int64)
            for c in np.unique(own):
                side = near[own == c].sum(0)
                total[:, c] += side[0]
                total[c, CLASSES:] += side[1, CLASSES:]  # bigrams of two common words are counted with the second
        yield parts(total)
    return summed(counted.mapInArrow(add, PARTS), (_STATES, _STATES))


def cluster(counted: DataFrame, common, rounds: int = ROUNDS) -> tuple[np.ndarray, list[np.ndarray]]:
    """Classes of the common words, whose rows ``counted`` has, and the class bigrams after each round that was kept."""
    spark, size = counted.sparkSession, len(common.value)

    def first(batches):
        for t in _gathered(batches):
            h, _, length, codes, counts = _columns(t)
            yield _moved(_ids(common.value, h), _first_classes(length, codes, counts))
    classes = _collected(counted.mapInArrow(first, _MOVED), size)
    history, share = [class_bigrams(counted, common, classes)], 2
    for round_ in range(rounds):
        state = spark.sparkContext.broadcast((classes, history[-1]))

        def exchange(batches, state=state, share=share, round_=round_):
            now, bigrams = state.value
            for h, ids, n, near, twice in _tables(batches, common.value, now):
                may = np.flatnonzero((h >> W.U64(7)) % W.U64(share) == W.U64(round_ % share))
                own = now[ids[may]].astype(np.int64)
                gain = gains(near[may], n[may], own, twice[may], bigrams)
                best = gain.argmax(1)
                better = gain[np.arange(len(may)), best] > gain[np.arange(len(may)), own] + 1e-6
                yield _moved(ids[may], np.where(better, best, own))
        moved = _collected(counted.mapInArrow(exchange, _MOVED), size)
        trial = np.where(moved < CLASSES, moved, classes)
        bigrams = class_bigrams(counted, common, trial)
        if likelihood(bigrams) >= likelihood(history[-1]):
            classes = trial
            history.append(bigrams)
        else:
            share *= 2
    return classes, history


def _only_common(common):
    """The rows of common words."""
    def run(batches):
        for batch in batches:
            known = _ids(common.value, batch.column(0).to_numpy().view(W.U64)) < COMMON
            yield batch.filter(pa.array(known))
    return run


def _shard(h: np.ndarray, bits: int) -> np.ndarray:
    return (h >> W.U64(64 - bits)).astype(np.int64) if bits else np.zeros(len(h), np.int64)


ASKED = "shard long, kind int, block long, words binary, counts binary, classes binary"
_ASKED_TYPES = [pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]


def _asked_batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(_ASKED_TYPES)],
                                      names=[c.split()[0] for c in ASKED.split(", ")])


def _entries(common, state, bits: int):
    """The word table, packed by shard; rarer words get the class that their neighbours make likeliest."""
    def run(batches):
        classes, bigrams = state.value
        for h, ids, n, near, twice in _tables(batches, common.value, classes):
            now = np.where(ids < COMMON, np.append(classes, 0)[np.minimum(ids, len(classes))], _END_CLASS).astype(np.uint8)
            rare = np.flatnonzero(ids == _RARE_ID)
            now[rare] = likeliest(near[rare], bigrams)
            shard = _shard(h, bits)
            rows = []
            for s in np.unique(shard):
                i = shard == s
                rows.append((int(s), 0, None, h[i].tobytes(), n[i].astype(np.int64).tobytes(), now[i].tobytes()))
            yield _asked_batch(rows)
    return run


def _questions(bits: int):
    """The distinct words of each block, packed by shard."""
    def run(batches):
        seen: dict[int, list[np.ndarray]] = {}
        for batch in batches:
            blocks, texts = batch.column(0).to_pylist(), batch.column(3).to_pylist()
            for at, chunk in W.text_chunks(texts):
                seq, size = _tokens(chunk)
                ends = np.cumsum(size)
                for i, block in enumerate(blocks[at:at + len(chunk)]):
                    seen.setdefault(block, []).append(seq[ends[i] - size[i]:ends[i]])
                    if len(seen[block]) >= 4096:
                        seen[block] = [np.unique(np.concatenate(seen[block]))]
        for block, found in seen.items():
            h = np.unique(np.concatenate(found))
            shard = _shard(h, bits)
            begin = np.searchsorted(shard, np.arange((1 << bits) + 1))
            yield _asked_batch([(s, 1, block, h[begin[s]:begin[s + 1]].tobytes(), None, None)
                                for s in np.flatnonzero(np.diff(begin)).tolist()])
    return run


ANSWER = "block long, shard long, counts binary, classes binary"


def _answers(batches):
    """Within a shard the word table comes first, then the questions; an answer follows the order of its question."""
    at, gathered, known = None, [], None
    for batch in batches:
        for shard, kind, block, words, counts, classes in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if shard != at:
                at, gathered, known = shard, [], None
            if kind == 0:
                gathered.append((np.frombuffer(words, W.U64), np.frombuffer(counts, np.int64), np.frombuffer(classes, np.uint8)))
                continue
            if known is None:
                known = [np.concatenate(x) for x in zip(*gathered, strict=True)] if gathered else [np.zeros(0, t) for t in (W.U64, np.int64, np.uint8)]
                order = np.argsort(known[0])
                known = [x[order] for x in known]
            asked = np.frombuffer(words, W.U64)
            count, cls = np.zeros(len(asked), np.int64), np.full(len(asked), _UNSEEN, np.uint8)
            if len(known[0]):
                place = np.minimum(np.searchsorted(known[0], asked), len(known[0]) - 1)
                hit = known[0][place] == asked
                count[hit], cls[hit] = known[1][place[hit]], known[2][place[hit]]
            yield pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), pa.array([shard], pa.int64()), pa.array([count.tobytes()]),
                                              pa.array([cls.tobytes()])], names=["block", "shard", "counts", "classes"])


ENCODED = ("doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, words_score double, classes binary")


def _encoder(n: int, v: int, in_class: np.ndarray):
    """Per text: counts, base score, log10 P(word | class) of the known words, and the classes of its tokens."""
    def run(texts: pa.Table, answers: pa.Table) -> pa.Table:
        chunks = [(at, *_tokens(chunk)) for at, chunk in W.text_chunks(texts.column(3).to_pylist())]
        # The block's distinct words in their order are what it asked, shard by shard.
        words = np.unique(np.concatenate([seq for _, seq, _ in chunks]))
        order = np.argsort(answers.column(1).to_numpy())
        count, cls = (np.concatenate([np.frombuffer(x, t) for x in answers.column(c).take(pa.array(order)).to_pylist()])
                      for c, t in ((2, np.int64), (3, np.uint8)))
        base = np.log10((count + 1.0) / (n + v + 1.0))
        inside = np.log10(np.maximum(count - DISCOUNT, 1e-9) / np.maximum(in_class[cls], 1))
        inside[(cls == _END_CLASS) | (cls == _UNSEEN)] = 0.0
        out = []
        for at, seq, size in chunks:
            place, begin = np.searchsorted(words, seq), np.cumsum(size) - size
            classes = cls[place]
            data = classes.tobytes()
            out.append(pa.table([
                texts.column(1).slice(at, len(size)).combine_chunks(), texts.column(2).slice(at, len(size)).combine_chunks(),
                pa.array(size, pa.int64()), pa.array(np.add.reduceat((classes != _UNSEEN).astype(np.int64), begin)),
                pa.array(np.add.reduceat(base[place], begin)), pa.array(np.add.reduceat(inside[place], begin)),
                pa.array([data[b:b + s] for b, s in zip(begin.tolist(), size.tolist(), strict=True)], pa.binary())],
                names=[c.split()[0] for c in ENCODED.split(", ")]))
        return pa.concat_tables(out)
    return run


def _pairs(classes: bytes) -> np.ndarray:
    """Class before and class of every token; a text begins after an end."""
    c = np.frombuffer(b"".join([bytes([_END_CLASS]), classes]), np.uint8).astype(np.int64)
    return c[:-1] * _STATES + c[1:]


def _transitions(batches):
    total = np.zeros(_STATES * _STATES)
    for batch in batches:
        for classes in batch.column(0).to_pylist():
            total += np.bincount(_pairs(classes), minlength=len(total))
    yield parts(total.reshape(_STATES, _STATES))


def transition_scores(counts: np.ndarray, in_class: np.ndarray, types: np.ndarray) -> np.ndarray:
    """log10 P(class | class before), smoothed with the classes' own frequencies.

    Column ``_UNSEEN`` holds the probability of an unseen word: what the
    discounts of the words have left, class by class. Each row sums to 1 over
    words, end and unseen.
    """
    seen = counts[:, :_END_CLASS + 1]
    total = seen.sum(0)
    share = (total + 1e-3) / (total.sum() + 1e-3 * len(total))
    p = (seen + SMOOTHING * share) / (seen.sum(1, keepdims=True) + SMOOTHING)
    # The end is a class of one word that is not discounted; an empty class leaves all it has.
    left = np.where(in_class[:CLASSES] > 0, DISCOUNT * types[:CLASSES] / np.maximum(in_class[:CLASSES], 1), 1.0)
    unseen = np.maximum(p[:, :CLASSES] @ left, 1e-12)
    return np.log10(np.hstack([p, unseen[:, None]]))


def language_scores(docs: DataFrame, *, held_out: Column, rounds: int = ROUNDS) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, perplexity`` for every row of ``docs``.

    The model learns from the rows that are not ``held_out`` (null counts as
    not). A null or empty text is an end token alone. Without any training row
    all words are unseen. Repeated rows count as often as they occur. Whole texts
    are read, very long ones as a chunk of their own; other columns are not read.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"),
                       F.coalesce(held_out, F.lit(False)).alias("held_out"))
    training = rows.where(~F.col("held_out")).select("text")
    common = spark.sparkContext.broadcast(common_words(training))
    counted = stored(training.mapInArrow(_count(common), PACKED).repartition("word_group").mapInArrow(_merge, COUNTED), "words")
    n, v = counted.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    named = stored(counted.mapInArrow(_only_common(common), COUNTED), "common")
    classes, history = cluster(named, common, rounds)
    state = spark.sparkContext.broadcast((classes, history[-1]))
    bits = max(0, int(v // SHARD).bit_length())
    entries = stored(counted.mapInArrow(_entries(common, state, bits), ASKED), "entries")

    def sizes(batches):
        total = np.zeros((2, _STATES))
        for batch in batches:
            for counts, classes in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                c = np.frombuffer(classes, np.uint8)
                total += [np.bincount(c, np.frombuffer(counts, np.int64), _STATES), np.bincount(c, minlength=_STATES)]
        yield parts(total)
    in_class, types = summed(entries.select("counts", "classes").mapInArrow(sizes, PARTS), (2, _STATES))

    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = int(size // BLOCK) + 1
    # Rows alike in id and text are dealt by where they were read, so no block has more of them than one partition.
    dealt = rows.select(F.pmod(F.xxhash64("doc_id", "text", F.spark_partition_id()), F.lit(blocks)).alias("block"), "doc_id", "held_out", "text")
    dealt = dealt.repartition(blocks, "block")
    asked = entries.unionByName(dealt.mapInArrow(_questions(bits), ASKED))
    answers = (asked.repartition("shard").sortWithinPartitions("shard", "kind").mapInArrow(_answers, ANSWER))
    encoded = stored(dealt.groupBy("block").cogroup(answers.groupBy("block"))
                     .applyInArrow(_encoder(n, v, in_class), ENCODED), "encoded")
    counts = summed(encoded.where(~F.col("held_out")).select("classes").mapInArrow(_transitions, PARTS), (_STATES, _STATES))
    moves = transition_scores(counts, in_class, types).reshape(-1)

    def score(batches):
        for batch in batches:
            words, classes = batch.column(5).to_numpy(zero_copy_only=False), batch.column(6).to_pylist()
            total = words + np.array([moves[_pairs(c)].sum() for c in classes])
            tokens = batch.column(2).to_numpy()
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(total), pa.array(10.0 ** np.minimum(-total / tokens, 300))],
                                             names=["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score", "perplexity"])
    out = encoded.mapInArrow(score, "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double, perplexity double")
    return out.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(n).cast("long").alias("train_tokens"), "base_score",
                      "score", "perplexity")


@query()
def op8_language_scores(spark, folder):
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2
    return language_scores(table(spark, folder, "documents"), held_out=held_out)
