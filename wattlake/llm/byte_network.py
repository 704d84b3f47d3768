"""A convolutional network over bytes, in numpy: filters of several widths, max pooling, softmax.

Trained by Adam on labelled windows, applied to batches of windows of a fixed length.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from numpy.lib.stride_tricks import sliding_window_view

#: The symbol behind the end of a text that is shorter than a window.
PAD = 256
#: Numbers that stand for a byte, widths of the filters in bytes, and filters of each width.
EMBED, WIDTHS, FILTERS = 8, (2, 3, 4, 5), 24
#: Bytes of a window. Neighbouring windows overlap, so that no filter misses a place between them.
WINDOW = 256
STRIDE = WINDOW - max(WIDTHS) + 1
#: Training: steps, windows of a step, longest window, and the rate of Adam.
STEPS, BATCH, LONGEST, RATE = 900, 128, 160, 4e-3


def windows_of(data: bytes) -> np.ndarray:
    """The windows that cover a text, as rows of symbols."""
    count = max(1, -(-(len(data) - WINDOW) // STRIDE) + 1)
    symbols = np.full((count - 1) * STRIDE + WINDOW, PAD, dtype=np.int16)
    symbols[: len(data)] = np.frombuffer(data, dtype=np.uint8)
    return sliding_window_view(symbols, WINDOW)[::STRIDE]


class ByteNetwork:
    def __init__(self, classes: int, seed: int = 7):
        rng = np.random.default_rng(seed)

        def normal(*shape, scale):
            return (rng.standard_normal(shape) * scale).astype(np.float32)

        units = FILTERS * len(WIDTHS)
        self.weights = {
            "embed": normal(PAD + 1, EMBED, scale=0.5),
            **{f"filter{w}": normal(w * EMBED, FILTERS, scale=(w * EMBED) ** -0.5) for w in WIDTHS},
            "bias": np.zeros(units, dtype=np.float32),
            "out": normal(units, classes, scale=units**-0.5),
            "out_bias": np.zeros(classes, dtype=np.float32),
        }
        self.weights["embed"][PAD] = 0

    def patches(self, embedded: np.ndarray, width: int) -> np.ndarray:
        """[windows, positions, width * EMBED]: what a filter sees at each position."""
        n, length, _ = embedded.shape
        flat = embedded.reshape(n, length * EMBED)
        return sliding_window_view(flat, width * EMBED, axis=1)[:, ::EMBED]

    def pooled(self, symbols: np.ndarray, places: bool) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
        """Every filter's largest answer in each window, and where it is."""
        embedded = self.weights["embed"][symbols]
        best, where = [], []
        for width in WIDTHS:
            seen = np.ascontiguousarray(self.patches(embedded, width))
            n, positions, size = seen.shape
            answers = (seen.reshape(-1, size) @ self.weights[f"filter{width}"]).reshape(n, positions, FILTERS)
            if places:
                at = answers.argmax(axis=1)
                where.append(at)
                best.append(np.take_along_axis(answers, at[:, None], axis=1)[:, 0])
            else:
                best.append(answers.max(axis=1))
        return np.concatenate(best, axis=1), where, embedded

    def outputs(self, pooled: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Active units and class probabilities."""
        active = np.maximum(pooled + self.weights["bias"], 0)
        logits = active @ self.weights["out"] + self.weights["out_bias"]
        grown = np.exp(logits - logits.max(axis=1, keepdims=True))
        return active, grown / grown.sum(axis=1, keepdims=True)

    def probabilities(self, symbols: np.ndarray) -> np.ndarray:
        return self.outputs(self.pooled(symbols, places=False)[0])[1]

    def gradients(self, symbols: np.ndarray, labels: np.ndarray) -> dict[str, np.ndarray]:
        pooled, where, embedded = self.pooled(symbols, places=True)
        active, p = self.outputs(pooled)
        n = len(labels)
        p[np.arange(n), labels] -= 1
        p /= n
        units = (p @ self.weights["out"].T) * (active > 0)
        found = {"out": active.T @ p, "out_bias": p.sum(axis=0), "bias": units.sum(axis=0)}
        embed = np.zeros_like(self.weights["embed"])
        rows = np.arange(n)[:, None]
        for turn, width in enumerate(WIDTHS):
            own = units[:, turn * FILTERS : (turn + 1) * FILTERS]
            seen = self.patches(embedded, width)[rows, where[turn]]  # what won, for each filter
            found[f"filter{width}"] = np.einsum("nfk,nf->kf", seen, own, optimize=True)
            kernel = self.weights[f"filter{width}"].reshape(width, EMBED, FILTERS)
            for k in range(width):
                at = symbols[rows, where[turn] + k].reshape(-1)
                back = (own[:, :, None] * kernel[k].T).reshape(-1, EMBED)
                for d in range(EMBED):
                    embed[:, d] += np.bincount(at, back[:, d], minlength=PAD + 1).astype(np.float32)
        embed[PAD] = 0
        return found | {"embed": embed}

    def train(self, pieces: list[bytes], labels: np.ndarray, seed: int = 11) -> ByteNetwork:
        """Steps over random windows of random pieces; lengths vary, so that short texts count too."""
        rng = np.random.default_rng(seed)
        mean = {name: np.zeros_like(w) for name, w in self.weights.items()}
        square = {name: np.zeros_like(w) for name, w in self.weights.items()}
        for step in range(1, STEPS + 1):
            chosen = rng.integers(0, len(pieces), BATCH)
            length = int(rng.choice([16, 32, 64, 128, LONGEST]))
            symbols = np.full((BATCH, max(length, max(WIDTHS))), PAD, dtype=np.int16)
            for row, at in enumerate(chosen):
                piece = pieces[at]
                start = rng.integers(0, max(1, len(piece) - length + 1))
                cut = piece[start : start + length]
                symbols[row, : len(cut)] = np.frombuffer(cut, dtype=np.uint8)
            rate = RATE * min(1.0, 2.0 * (1.0 - step / (STEPS + 1)))
            for name, gradient in self.gradients(symbols, labels[chosen]).items():
                mean[name] = 0.9 * mean[name] + 0.1 * gradient
                square[name] = 0.999 * square[name] + 0.001 * gradient**2
                top = mean[name] / (1 - 0.9**step)
                self.weights[name] -= (rate * top / (np.sqrt(square[name] / (1 - 0.999**step)) + 1e-8)).astype(
                    np.float32
                )
        return self


def in_blocks(texts: list[bytes], windows: int = 1024) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Windows of texts in blocks of bounded size, with the number of the text of each window."""
    held, owners, count = [], [], 0
    for number, data in enumerate(texts):
        own = windows_of(data)
        for start in range(0, len(own), windows):
            part = own[start : start + windows]
            held.append(part)
            owners.append(np.full(len(part), number))
            count += len(part)
            if count >= windows:
                yield np.concatenate(held), np.concatenate(owners)
                held, owners, count = [], [], 0
    if held:
        yield np.concatenate(held), np.concatenate(owners)
