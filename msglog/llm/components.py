"""Connected components: of links in tables (the library's), and of links in arrays."""

from __future__ import annotations

import numpy as np

from msglog.operators.components import components  # noqa: F401  (re-exported for the operators)


def merge_labels(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Join the label sets of linked rows; a label is the smallest row number of its set."""
    while True:
        one, two = label[a], label[b]
        differ = one != two
        if not differ.any():
            return label
        a, b = a[differ], b[differ]
        np.minimum.at(label, np.maximum(one, two)[differ], np.minimum(one, two)[differ])
        while True:
            up = label[label]
            if np.array_equal(up, label):
                break
            label = up
