"""A linear-chain conditional random field over word-shape features, in numpy batches."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from llm.byteops import LOWER, span_hashes

# Words that tell of personal data nearby, or stand for a sign in an address.
LEXICON = (
    "at", "[at]", "(at)", "dot", "[dot]", "(dot)", "mail", "email", "e-mail", "address", "contact", "write", "phone",
    "call", "tel", "telephone", "mobile", "fax", "ring", "card", "visa", "number", "ip", "host", "server", "login",
    "org", "com", "net",
)
_ENDS = np.zeros(256, bool)
_ENDS[list(b".,:;!?")] = True
_ODD = np.zeros(256, bool)
_ODD[list(b"#$%&*!?/\\|<>={}~^_;\"")] = True
_IS_DIGIT = np.zeros(256, bool)
_IS_DIGIT[list(b"0123456789")] = True
_IS_LETTER = np.zeros(256, bool)
_IS_LETTER[[*range(ord("a"), ord("z") + 1), *range(ord("A"), ord("Z") + 1), *range(0x80, 0x100)]] = True
_DIGIT_BUCKET = np.array([0, 1, 2, 2, 3, 4, 4, 5, 5, 5, 5, 5, 6, 6, 7, 7, 7, 7, 7, 7, 8])
# Values of the categorical features: digits and letters; signs; lexicon word; the first two of the neighbours.
SIZES = (9 * 3, 2 * 2 * 5 * 3 * 2, len(LEXICON) + 1)
WINDOW = ((0, -1), (0, 1), (2, -1), (2, 1), (0, -2), (0, 2))


def _lexicon() -> tuple[np.ndarray, np.ndarray]:
    data = np.frombuffer(" ".join(LEXICON).encode(), np.uint8)
    ends = np.append(np.flatnonzero(data == 0x20), len(data))
    starts = np.concatenate([[0], ends[:-1] + 1])
    hashes = span_hashes(data, starts, ends)
    order = np.argsort(hashes)
    return hashes[order], order + 1


_LEXICON = _lexicon()


def word_features(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """(words, 3): shape class, sign class and lexicon number of each word."""
    count = lambda mask: (s := np.concatenate([[0], np.cumsum(mask, dtype=np.int64)]))[ends] - s[starts]
    digits, letters = count(_IS_DIGIT[data]), count(_IS_LETTER[data])
    dots, hyphens = count(data == ord(".")), count(data == ord("-"))
    trailing = (ends - starts > 1) & _ENDS[data[ends - 1]] if len(ends) else np.zeros(0, bool)
    dots = dots - (trailing & (data[ends - 1] == ord("."))) if len(ends) else dots
    shape = _DIGIT_BUCKET[np.minimum(digits, 20)] * 3 + np.where(letters > 3, 2, np.minimum(letters, 1))
    first = data[starts] if len(starts) else data[:0]
    signs = (count(data == ord("@")) > 0).astype(np.int64)
    signs = signs * 2 + ((first == ord("+")) | (first == ord("(")))
    signs = signs * 5 + np.minimum(dots, 4)
    signs = signs * 3 + np.minimum(hyphens, 2)
    signs = signs * 2 + (count(_ODD[data]) > 0)
    hashes = span_hashes(LOWER[data], starts, ends - trailing)
    at = np.minimum(np.searchsorted(_LEXICON[0], hashes), len(LEXICON) - 1)
    known = np.where(_LEXICON[0][at] == hashes, _LEXICON[1][at], 0) if len(hashes) else hashes.astype(np.int64)
    return np.stack([shape, signs, known.astype(np.int64)], axis=1)


@dataclass
class Field:
    """Weights: one table a feature (own and of neighbours), transitions, start and end; label 0 is outside."""

    tables: list[np.ndarray]
    transition: np.ndarray
    start: np.ndarray
    end: np.ndarray

    def emissions(self, features: np.ndarray, first: np.ndarray) -> np.ndarray:
        """(words, labels) scores; neighbours beyond a sequence add nothing."""
        out = sum(self.tables[f][features[:, f]] for f in range(3))
        for table, (f, shift) in zip(self.tables[3:], WINDOW, strict=True):
            here, there = _shifted(len(features), first, shift)
            out[here] += table[features[there, f]]
        return out

    def quiet(self) -> bool:
        """Whether words without digits, @ and lexicon words among such neighbours stay outside, by the weights."""
        signs = np.arange(SIZES[1])[: SIZES[1] // 2]
        own = self.tables[0][:3][:, None] + self.tables[1][signs][None] + self.tables[2][0]
        ahead = own[..., 1:] - own[..., :1]
        for table, (f, _) in zip(self.tables[3:], WINDOW, strict=True):
            near = table[:3] if f == 0 else table[:1]
            # A neighbour may be missing too, and then adds nothing.
            ahead = ahead + np.maximum((near[:, 1:] - near[:, :1]).max(axis=0), 0)
        return bool((ahead.max() + 2 * self._gain()) < 0)

    def tag(self, features: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Best labels of all words. Sequences of quiet words alone are outside; the others are decoded."""
        labels = np.zeros(len(features), np.int64)
        pick = np.arange(len(first) - 1)
        if self.quiet():
            loud = (features[:, 0] >= 3) | (features[:, 1] >= SIZES[1] // 2) | (features[:, 2] > 0)
            sums = np.concatenate([[0], np.cumsum(loud)])
            pick = np.flatnonzero(sums[first[1:]] > sums[first[:-1]])
        length = (first[1:] - first[:-1])[pick]
        part = np.concatenate([[0], np.cumsum(length)])
        rows = np.arange(part[-1]) + np.repeat(first[:-1][pick] - part[:-1], length)
        labels[rows] = self.decode(self.emissions(features[rows], part), part)
        return labels

    def _gain(self) -> float:
        """The most that a transition can win over staying outside."""
        best = max(self.transition.max(), self.start.max(), self.end.max())
        return best - min(self.transition[0, 0], self.start[0], self.end[0])

    def undecided(self, emissions: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Sequences in which some labelling could beat "all outside".

        Leaving label 0 changes at most two transitions a word more than it has words,
        so if every word loses more than twice the best transition gains, none does.
        """
        open_words = emissions[:, 1:].max(axis=1) - emissions[:, 0] + 2 * self._gain() >= 0
        sums = np.concatenate([[0], np.cumsum(open_words)])
        return np.flatnonzero(sums[first[1:]] > sums[first[:-1]])

    def decode(self, emissions: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Best labels by Viterbi, one step for all sequences of a batch at a time."""
        labels = np.zeros(len(emissions), np.int64)
        todo = self.undecided(emissions, first)
        todo = todo[np.argsort(-(first[todo + 1] - first[todo]), kind="stable")]
        if not len(todo):
            return labels
        begin, length = first[todo], first[todo + 1] - first[todo]
        active = lambda t: int(np.searchsorted(-length, -t, "left"))
        score = self.start + emissions[begin]
        back, rows = [], np.arange(len(todo))
        final = np.zeros(len(todo), np.int64)
        for t in range(1, int(length[0])):
            n = active(t)
            final[n : len(score)] = (score[n:] + self.end).argmax(axis=1)
            paths = score[:n, :, None] + self.transition
            came = paths.argmax(axis=1)
            score = np.take_along_axis(paths, came[:, None, :], axis=1)[:, 0] + emissions[begin[:n] + t]
            back.append(came.astype(np.int8))
        final[: len(score)] = (score + self.end).argmax(axis=1)
        current = final.copy()
        for t in range(int(length[0]) - 1, -1, -1):
            n = active(t)
            labels[begin[:n] + t] = current[:n]
            if t:
                current[:n] = back[t - 1][rows[:n], current[:n]]
        return labels


def _shifted(n: int, first: np.ndarray, shift: int) -> tuple[np.ndarray, np.ndarray]:
    """Words that have a neighbour ``shift`` places on in their sequence, and that neighbour."""
    sequence = np.repeat(np.arange(len(first) - 1), np.diff(first))
    here = np.arange(max(0, -shift), n - max(0, shift))
    there = here + shift
    same = sequence[here] == sequence[there]
    return here[same], there[same]


def train(features: np.ndarray, first: np.ndarray, labels: np.ndarray, n_labels: int, steps: int = 120) -> Field:
    """Maximum a posteriori weights by Adam on the log likelihood, with exact gradients."""
    shapes = [SIZES[f] for f in range(3)] + [SIZES[f] for f, _ in WINDOW]
    parts = [np.zeros((s, n_labels)) for s in shapes]
    parts += [np.zeros((n_labels, n_labels)), np.zeros(n_labels), np.zeros(n_labels)]
    moment, scale = [np.zeros_like(p) for p in parts], [np.zeros_like(p) for p in parts]
    for step in range(1, steps + 1):
        field = Field(parts[:-3], *parts[-3:])
        slopes = _gradient(field, features, first, labels)
        for i, slope in enumerate(slopes):
            slope = slope - 0.02 * parts[i]
            moment[i] = 0.9 * moment[i] + 0.1 * slope
            scale[i] = 0.99 * scale[i] + 0.01 * slope * slope
            rate = 0.15 * moment[i] / (1 - 0.9**step)
            parts[i] = parts[i] + rate / (np.sqrt(scale[i] / (1 - 0.99**step)) + 1e-8)
    small = [p.astype(np.float32) for p in parts]
    return Field(small[:-3], *small[-3:])


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis=axis))


def _gradient(field: Field, features: np.ndarray, first: np.ndarray, labels: np.ndarray) -> list[np.ndarray]:
    """Observed less expected counts of every weight; sequences of one length run together."""
    emissions = field.emissions(features, first)
    k = emissions.shape[1]
    target = np.zeros_like(emissions)
    target[np.arange(len(labels)), labels] = 1
    expected = np.zeros_like(emissions)
    transition = np.zeros((k, k))
    length = np.diff(first)
    for t in np.unique(length[length > 0]):
        rows = first[:-1][length == t][:, None] + np.arange(t)
        e = emissions[rows]
        forward, backward = np.zeros_like(e), np.zeros_like(e)
        forward[:, 0] = field.start + e[:, 0]
        for i in range(1, t):
            forward[:, i] = _log_sum(forward[:, i - 1, :, None] + field.transition, 1) + e[:, i]
        backward[:, -1] = field.end
        for i in range(t - 2, -1, -1):
            backward[:, i] = _log_sum(field.transition + (e[:, i + 1] + backward[:, i + 1])[:, None, :], 2)
        whole = _log_sum(forward[:, -1] + field.end, 1)
        expected[rows] = np.exp(forward + backward - whole[:, None, None])
        for i in range(1, t):
            joint = forward[:, i - 1, :, None] + field.transition + (e[:, i] + backward[:, i])[:, None, :]
            transition -= np.exp(joint - whole[:, None, None]).sum(axis=0)
            np.add.at(transition, (labels[rows[:, i - 1]], labels[rows[:, i]]), 1)
    gap = target - expected
    slopes = []
    for f in range(3):
        slope = np.zeros_like(field.tables[f])
        np.add.at(slope, features[:, f], gap)
        slopes.append(slope)
    for table, (f, shift) in zip(field.tables[3:], WINDOW, strict=True):
        here, there = _shifted(len(features), first, shift)
        slope = np.zeros_like(table)
        np.add.at(slope, features[there, f], gap[here])
        slopes.append(slope)
    full = length > 0
    return [*slopes, transition, gap[first[:-1][full]].sum(axis=0), gap[first[1:][full] - 1].sum(axis=0)]


