"""Personal data by a semi-Markov conditional random field over fixed base patterns.

The base patterns find well-formed values.  The field finds values that are written otherwise
(an address with "(at)", a number without its plus sign): it scores whole candidate spans, not
single tokens, with features of the span and its surroundings, and a dynamic programme over spans
of at most ``LONGEST`` tokens chooses boundaries and kinds together.  A span is added only if the
probability of its kind at one of its tokens, from the forward and backward sums, reaches ``SURE``
and no base span overlaps it.

Only regions around digits groups and at-signs can hold a candidate; every region of every whole
text is scored.  Training takes the regions of a bounded sample of documents, with the base spans
as labels, and rewritten copies of them, so that the field learns other spellings.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mairie.llm.textbytes import slices, tidy

KINDS = ("email", "ip", "card", "phone")
SAMPLE = 4_000  # documents that training regions are taken from
LONGEST = 16  # tokens of a span
SURE = 0.9
_WEIGHTS = 1 << 13

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
# A match always ends with its run of digits, so only the start of a run can start one.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_CORE = re.compile(r"@|[(\[{]\x20?(?:at|AT)\x20?[)\]}]|\+?\(?[0-9](?:[\x20().+-]{0,2}[0-9]){5,}")
_MAYBE = re.compile(r"[0-9@(\[{]")
_TOKEN = re.compile(r"[A-Za-z]+|[0-9]+|\x20+|[^A-Za-z0-9\x20]")


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = int(d) * (1 + k % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _emails(text: str) -> list[tuple[int, int, str]]:
    """Leftmost addresses, each told from its @ outwards: the time is linear in the text."""
    found, end, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            end = domain.end()
            found.append((start, end, "email"))
        at = text.find("@", at + 1)
    return found


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the base patterns, by start and then kind; code points, end exclusive."""
    found = []
    if "@" in text:
        found += _emails(text)
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            parts = [p.lstrip("0") for p in m[0].split(".")]
            if all(len(p) <= 3 and int(p or "0") <= 255 for p in parts):
                found.append((m.start(), m.end(), "ip"))
        for m in _CARD.finditer(text):
            digits = m[0].replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and luhn(digits):
                found.append((m.start(), m.end(), "card"))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 9 <= len(_DIGIT.findall(m[0])) <= 15:
                    found.append((m.start(), m.end(), "phone"))
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def _reach(text: str, at: int, step: int) -> int:
    """Where ``LONGEST`` tokens after (``step`` 1) or before (-1) a place end; a run of letters or digits is one, however long."""
    width = 4 * LONGEST
    while True:
        # Runs have the same bounds read from either side.
        near = text[at : at + width] if step > 0 else text[max(0, at - width) : at][::-1]
        end = max((m.end() for m in islice(_TOKEN.finditer(near), LONGEST)), default=0)
        if len(near) < width or end < len(near):
            return at + step * end
        width *= 2


def regions(text: str) -> list[tuple[int, int]]:
    """Stretches of ``LONGEST`` tokens on either side of every possible core, merged where they touch.

    A span has at most that many tokens, so each one that holds a core lies inside with whole tokens.
    """
    out: list[list[int]] = []
    if not _MAYBE.search(text):
        return []
    for m in _CORE.finditer(text):
        low, high = _reach(text, m.start(), -1), _reach(text, m.end(), 1)
        if out and low <= out[-1][1]:
            out[-1][1] = max(high, out[-1][1])
        else:
            out.append([low, high])
    return [(a, b) for a, b in out]


def _shape(token: str) -> str:
    if token.isdigit() and token.isascii():
        return f"9{min(len(token), 5)}"
    if token.isalpha() and token.isascii():
        return "a"
    return " " if token.startswith(" ") else token[0]


class Lattice:
    """Candidate spans of one region: (first token, last token + 1) and the feature numbers of each."""

    def __init__(self, text: str):
        at = [(m.start(), m.end()) for m in _TOKEN.finditer(text)]
        self.at, self.text = at, text
        tokens = [text[a:b] for a, b in at]
        shapes = [_shape(t) for t in tokens]
        self.spans: list[tuple[int, int]] = []
        features: list[list[int]] = []
        digits = [len(t) if s[0] == "9" else 0 for t, s in zip(tokens, shapes, strict=True)]
        for i in range(len(tokens)):
            if shapes[i] == " " or not (shapes[i][0] == "9" or shapes[i] in "a+("):
                continue
            n, mark = 0, False
            for j in range(i, min(len(tokens), i + LONGEST)):
                n += digits[j]
                mark |= tokens[j] in ("@", "at", "AT")
                if n > 30:
                    break
                if shapes[j][0] not in "9a" or n < 6 and not mark:
                    continue
                self.spans.append((i, j + 1))
                features.append(self._features(tokens, shapes, i, j + 1, n))
        self.features = np.array(features, np.int64) if features else np.zeros((0, 1), np.int64)

    def _features(self, tokens, shapes, i, j, n) -> list[int]:
        inner = tokens[i:j]
        signs = "".join(sorted({s for s in shapes[i:j] if s[0] not in "9a"}))
        pattern = "".join(shapes[i:j])
        number = "".join(t for t in inner if t.isdigit() and t.isascii())
        groups = [len(t) for t in inner if t.isdigit() and t.isascii()]
        left = shapes[i - 1] if i else "^"
        right = shapes[j] if j < len(shapes) else "$"
        after = shapes[j + 1][0] if j + 1 < len(shapes) else "$"
        letters = sum(s == "a" for s in shapes[i:j])
        octets = len(groups) == 4 and all(g <= 3 and int(t) <= 255 for g, t in zip(groups, [t for t in inner if t.isdigit() and t.isascii()], strict=True))
        facts = (
            f"bias{len(inner) > 1}", f"pattern{re.sub('9[1-5]', '9', pattern)[:12]}", f"signs{signs}", f"digits{min(n, 20)}",
            f"groups{len(groups)}", f"lengths{groups[:6]}", f"letters{min(letters, 6)}", f"first{shapes[i]}", f"last{shapes[j - 1]}",
            f"left{left[0]}{shapes[i][0]}", f"right{right[0]}{after}", f"luhn{12 <= n <= 19 and not letters and luhn(number)}",
            f"octets{octets and not letters}", f"mark{sum(t in ('@', 'at', 'AT') for t in inner)}", f"dots{min(inner.count('.'), 4)}",
            f"sizes{letters > 0}{min(n, 20) // 3}{'+' in signs}",
        )
        return [zlib.crc32(f.encode()) % _WEIGHTS for f in facts]

    def marginals(self, weights: np.ndarray) -> tuple[np.ndarray, float]:
        """Probability of each (span, kind), and the log of the partition sum; a token outside spans scores 0."""
        scores = weights[:, self.features].sum(axis=2)  # (kinds, spans)
        size = len(self.at)
        best = scores.max(axis=0) if scores.size else np.zeros(0)
        span_score = best + np.log(np.exp(scores - best).sum(axis=0)) if scores.size else best
        ends: list[list[int]] = [[] for _ in range(size + 1)]
        begins: list[list[int]] = [[] for _ in range(size + 1)]
        for k, (i, j) in enumerate(self.spans):
            ends[j].append(k)
            begins[i].append(k)
        forward, backward = np.zeros(size + 1), np.zeros(size + 1)
        first = np.array([i for i, _ in self.spans], np.int64)
        last = np.array([j for _, j in self.spans], np.int64)
        for t in range(1, size + 1):
            forward[t] = forward[t - 1]
            if ends[t]:
                forward[t] = np.logaddexp.reduce(np.append(forward[first[ends[t]]] + span_score[ends[t]], forward[t]))
        for t in range(size - 1, -1, -1):
            backward[t] = backward[t + 1]
            if begins[t]:
                backward[t] = np.logaddexp.reduce(np.append(backward[last[begins[t]]] + span_score[begins[t]], backward[t]))
        inside = forward[first] + backward[last] - forward[size] if len(first) else np.zeros(0)
        return np.exp(scores + inside), float(forward[size])

    def best(self, weights: np.ndarray) -> list[tuple[int, int, str, float]]:
        """The best segmentation's spans (start, end in characters), each with the chance that a span of its kind stands there."""
        if not self.spans:
            return []
        scores = weights[:, self.features].sum(axis=2)
        kind, value = scores.argmax(axis=0), scores.max(axis=0)
        ends: dict[int, list[int]] = {}
        for k, (_, j) in enumerate(self.spans):
            ends.setdefault(j, []).append(k)
        total, back = [0.0], [-1]
        for t in range(1, len(self.at) + 1):
            choice = max(((total[self.spans[k][0]] + value[k], k) for k in ends.get(t, ())), default=(-np.inf, -1))
            keep = choice[0] > total[t - 1]
            total.append(choice[0] if keep else total[t - 1])
            back.append(choice[1] if keep else -1)
        chance, _ = self.marginals(weights)
        # Spans over one token exclude each other, so their sum is the chance that it belongs to the kind.
        over = np.zeros((len(KINDS), len(self.at) + 1))
        for k, (i, j) in enumerate(self.spans):
            over[:, i] += chance[:, k]
            over[:, j] -= chance[:, k]
        over = np.cumsum(over, axis=1)
        out, t = [], len(self.at)
        while t > 0:
            k = back[t]
            if k < 0:
                t -= 1
                continue
            i, j = self.spans[k]
            out.append((self.at[i][0], self.at[j - 1][1], KINDS[kind[k]], float(over[kind[k], i:j].max())))
            t = i
        return out[::-1]


def rewritten(text: str, spans: list[tuple[int, int, str]]) -> list[tuple[str, list[tuple[int, int, str]]]]:
    """The region with its spans in other spellings, as further training examples."""
    ways = [
        lambda v, k: v.replace("@", " (at) ") if k == "email" else v.lstrip("+") if k == "phone" else v,
        lambda v, k: v.replace("@", "[at]") if k == "email" else re.sub(r"[^0-9]+", "-", v.lstrip("+")) if k == "phone"
        else " ".join(re.findall("[0-9]{1,4}", v)) if k == "card" else v,
        lambda v, k: re.sub(r"[^0-9]+", ".", v.lstrip("+")) if k == "phone"
        else ".".join(re.findall("[0-9]{1,4}", v)) if k == "card" else v.replace("@", " @ ") if k == "email" else v,
    ]
    # Names of one and of several words, and short domains: the texts' own addresses may all have one form.
    name = lambda v: re.sub("[^A-Za-z]+", "", v.split("@")[0]) or "a"
    host = lambda v: ".".join(v.split("@")[1].split(".")[-2:])
    ways += [
        lambda v, k: f"{name(v)} (at) {host(v)}" if k == "email" else v,
        lambda v, k: f"{name(v)}.{name(v)}-{name(v)} (at) {host(v)}" if k == "email" else v,
        lambda v, k: f"{name(v)}.{name(v)[:1]}[at]{v.split('@')[1]}" if k == "email" else v,
        lambda v, k: f"{name(v)} @ {host(v)}" if k == "email" else v,
    ]
    out = []
    words = re.findall("[A-Za-z]+", text)
    if len(words) > 1:  # the mark between plain words is no address
        for mark in (" (at) ", " @ ", "[at]"):
            lead = f"{words[0]}{mark}{words[-1]} "
            out.append((lead + text, [(a + len(lead), b + len(lead), kind) for a, b, kind in spans]))
    for way in ways:
        made, at, moved = "", 0, []
        for a, b, kind in spans:
            made += text[at:a]
            value = way(text[a:b], kind)
            moved.append((len(made), len(made) + len(value), kind))
            made, at = made + value, b
        out.append((made + text[at:], moved))
    return out


def train(examples: list[tuple[str, list[tuple[int, int, str]]]], epochs: int = 12, rate: float = 0.3) -> np.ndarray | None:
    """Weights (kinds, features) that maximise the likelihood of the labelled regions; None without any span."""
    lattices = []
    for text, spans in examples:
        lattice = Lattice(text)
        place = {(lattice.at[i][0], lattice.at[j - 1][1]): k for k, (i, j) in enumerate(lattice.spans)}
        gold = [(KINDS.index(kind), place[a, b]) for a, b, kind in spans if (a, b) in place]
        if lattice.spans:
            lattices.append((lattice, gold))
    if not any(gold for _, gold in lattices):
        return None
    weights = np.zeros((len(KINDS), _WEIGHTS))
    squares = np.full(weights.shape, 1e-2)
    rng = np.random.default_rng(2)
    for _ in range(epochs):
        for n in rng.permutation(len(lattices)):
            lattice, gold = lattices[n]
            chance, _ = lattice.marginals(weights)
            step = -chance
            for kind, k in gold:
                step[kind, k] += 1
            used = np.unique(lattice.features)
            spot = np.searchsorted(used, lattice.features)
            grad = np.zeros((len(KINDS), len(used)))
            for kind in range(len(KINDS)):
                np.add.at(grad[kind], spot, np.repeat(step[kind][:, None], spot.shape[1], axis=1))
            grad -= 1e-3 * weights[:, used]
            squares[:, used] += grad**2
            weights[:, used] += rate * grad / np.sqrt(squares[:, used])
    return weights


def _examples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for text in batch.column("text").to_pylist():
            spans = base_spans(text or "")
            for a, b in regions(text or ""):
                if b - a > 400:
                    continue  # a long table of numbers teaches no more than its first rows would
                inside, last = [], -1
                for s, e, kind in spans:
                    if a <= s and e <= b and s >= last:
                        inside.append(f"{s - a}:{e - a}:{kind}")
                        last = e
                rows.append((text[a:b], inside))
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.list_(pa.string()))], names=["region", "spans"]
        )


def fit(docs: DataFrame, sample: int = SAMPLE, most: int = 400) -> np.ndarray | None:
    """Weights from at most ``most`` regions of at most ``sample`` documents, in hashed orders."""
    ids = docs.select("doc_id").where("doc_id is not null").orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample).distinct()
    chosen = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id", "left_semi").select("text")
    found = chosen.mapInArrow(tidy(_examples), "region string, spans array<string>").distinct()
    found = found.orderBy(F.xxhash64("region"), "region").limit(most).toArrow().to_pylist()
    examples = []
    for r in found:
        spans = [(int(s), int(e), k) for s, e, k in (x.split(":") for x in r["spans"])]
        examples.append((r["region"], spans))
        if spans:
            examples += rewritten(r["region"], spans)
    return train(examples)


def all_spans(text: str, weights: np.ndarray | None, base: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    """Base spans and those that the field adds."""
    if weights is None:
        return base
    added = []
    for a, b in regions(text):
        clear = [s for s in base if s[0] < b and s[1] > a]
        for start, end, kind, chance in Lattice(text[a:b]).best(weights):
            start, end = start + a, end + a
            if chance >= SURE and _possible(text[start:end], kind) and not any(s[0] < end and s[1] > start for s in clear):
                added.append((start, end, kind))
    return sorted(base + added, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def _possible(value: str, kind: str) -> bool:
    """Rules without exception: a card passes Luhn, an address has four parts of at most 255."""
    numbers = re.findall("[0-9]+", value)
    if kind == "card":
        return 12 <= sum(map(len, numbers)) <= 19 and luhn("".join(numbers))
    if kind == "ip":
        return len(numbers) == 4 and all(len(n) <= 3 and int(n) <= 255 for n in numbers)
    return True


def _joined(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for a, b, kind in spans)


def _judge(text: str | None, weights: np.ndarray | None) -> tuple[str, str, str | None]:
    """Base spans, all spans, and the text with kinds in their place."""
    if not text:
        return "", "", text
    base = base_spans(text)
    spans = all_spans(text, weights, base)
    parts, at = [], 0
    for a, b, kind in spans:
        if a >= at:
            parts += [text[at:a], f"<{kind}>"]
        at = max(at, b)
    return _joined(base), _joined(spans), "".join([*parts, text[at:]]) if spans else text


def find_private(docs: DataFrame, weights: np.ndarray | None) -> DataFrame:
    """(doc_id, base, spans) of each row: ``kind:start:end`` lists over the whole text.

    Null and empty texts have none.  Every row is judged on its own, so repeated rows and missing
    ids are as any other.  Other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "_text", 2 << 20):
            found = [_judge(text, weights) for text in batch.column("_text").to_pylist()]
            lists = [pa.array([r[k] for r in found], pa.string()) for k in range(2)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *lists], names=["doc_id", "base", "spans"])

    rows = docs.select("doc_id", F.col("text").alias("_text"))
    return rows.mapInArrow(tidy(run), "doc_id bigint, base string, spans string")


def mask_private(docs: DataFrame, weights: np.ndarray | None) -> DataFrame:
    """``docs`` with each span replaced by its kind; n_chars, where there is one, follows the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 2 << 20):
            texts = [_judge(text, weights)[2] for text in batch.column("text").to_pylist()]
            at = batch.schema.get_field_index("text")
            yield batch.set_column(at, batch.schema.field(at), pa.array(texts, batch.schema.field(at).type))

    masked = docs.mapInArrow(tidy(run), docs.schema)
    if "n_chars" in docs.columns:
        masked = masked.withColumn("n_chars", F.when(F.col("text").isNotNull(), F.length("text").cast("bigint")).otherwise(F.col("n_chars")))
    return masked
