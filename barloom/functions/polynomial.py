"""Weights of a least-squares polynomial over a short window."""

from __future__ import annotations

import numpy as np


def smoothing_weights(window: int, degree: int) -> np.ndarray:
    """Row j holds the weights that give the fitted value at position j of the window."""
    if window % 2 == 0 or degree >= window:
        raise ValueError("the window must be odd and longer than the degree")
    x = np.arange(window, dtype=float) - window // 2
    basis, _ = np.linalg.qr(np.vander(x / max(window // 2, 1), degree + 1, increasing=True))
    return basis @ basis.T
