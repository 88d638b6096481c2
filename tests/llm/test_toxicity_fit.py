"""The curve of the toxicity scores is fitted to the end, however far the classes are apart."""

import numpy as np

from siftline.llm.toxicity import fit_logistic, logit


def test_copies_and_outliers_do_not_throw_the_fit():
    for seed in range(30):  # whole Newton steps missed most toxic rows in some of these
        rng, i = np.random.default_rng(seed), np.arange(2000)
        toxic = i % 10 == 0
        x = np.where(toxic[:, None], rng.normal((1.4, 3.5), (0.25, 1.3), (2000, 2)), rng.normal((0, -0.4), (0.25, 0.9), (2000, 2)))
        x[~toxic & (i % 9 == 4)] = -8.7, -16.4  # a large group of copies
        x[toxic & (i % 300 == 0)] = 27, 21
        slopes, shift = fit_logistic(x, toxic.astype(float), logit(0.1))
        z = x @ np.array(slopes) + shift
        assert min(slopes) > 0
        assert (z > 0)[toxic].mean() > 0.98
        assert (z > 0)[~toxic].mean() < 0.01
        # the slope of the loss is that of the ridge alone
        p = 1 / (1 + np.exp(-z))
        assert np.allclose(((x - x.mean(0)) / x.std(0)).T @ (p - toxic) + 1e-2 * np.array(slopes) * x.std(0), 0, atol=1e-2)
