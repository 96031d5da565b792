"""Gradients of the attention model, and how much is worked on at a time."""

import tracemalloc

import numpy as np
import pytest

from torquelake.llm import attention
from torquelake.llm.attention import Attention, Shape, sequences, vocabulary, windows


def batch(shape):
    random = np.random.default_rng(5)
    texts = [random.integers(0, 300, n) for n in random.integers(0, 90, 120)]
    counts = np.bincount(np.concatenate(texts), minlength=301) + 1.0
    words = vocabulary(counts, shape)
    inputs, targets, lengths = sequences(texts, 300)
    place = windows(lengths, shape)[:256]
    at, scored = np.maximum(place, 0), place[:, -shape.step :]
    return Attention(shape, words.prior), (words.input_of[inputs][at], place >= 0, words.class_of[targets][at[:, -shape.step :]], scored >= 0)


def test_gradients_are_slopes_of_the_loss_whatever_the_pieces(monkeypatch):
    model, given = batch(Shape(own_inputs=250))
    loss, whole = model.gradients(*given)
    monkeypatch.setattr(attention, "PIECE", 7)
    again, pieces = model.gradients(*given)
    assert again == pytest.approx(loss)
    for name, g in whole.items():
        assert g.shape == model.p[name].shape and np.allclose(pieces[name], g, atol=1e-5)
        kept, step = model.p[name], 1e-2 / np.sqrt((g**2).sum())
        up, down = (model.__setattr__("p", model.p | {name: kept + sign * step * g}) or model.gradients(*given)[0] for sign in (1, -1))
        model.p = model.p | {name: kept}
        assert (up - down) / (2 * step) == pytest.approx((g**2).sum(), rel=0.05)


def test_a_batch_is_worked_on_in_pieces_that_fit_a_cache():
    model, given = batch(Shape())
    model.gradients(*given)
    tracemalloc.start()
    model.gradients(*given)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 3_000_000  # 256 windows at once take twice that
