"""Layer maths: numeric gradient checks for dense, conv and pool layers."""

import numpy as np
import pytest

from tessera.operators import nets
from tessera.operators.models import Model


def _num_grad(layers, params, x, y, l2, i, k, eps=1e-6):
    g = np.zeros_like(params[i][k])
    it = np.nditer(params[i][k], flags=["multi_index"])
    for _ in it:
        idx = it.multi_index
        old = params[i][k][idx]
        params[i][k][idx] = old + eps
        lp, _ = nets.loss_and_grads(layers, params, x, y, l2)
        params[i][k][idx] = old - eps
        lm, _ = nets.loss_and_grads(layers, params, x, y, l2)
        params[i][k][idx] = old
        g[idx] = (lp - lm) / (2 * eps)
    return g


@pytest.mark.parametrize("spec,dims", [
    ([{"kind": "dense", "activation": "tanh", "n_out": 5}, {"kind": "dense", "activation": "sigmoid", "n_out": 4},
      {"kind": "output", "activation": "softmax", "n_out": 3}], (6,)),
    ([{"kind": "conv", "activation": "relu", "n_out": 2, "kernel": 3, "channels_in": 2},
      {"kind": "pool", "kernel": 2, "stride": 2},
      {"kind": "output", "activation": "softmax", "n_out": 3}], (2, 7, 7)),
    ([{"kind": "conv", "activation": "tanh", "n_out": 2, "kernel": 2, "stride": 2, "channels_in": 1},
      {"kind": "flatten"}, {"kind": "dense", "activation": "leakyrelu", "n_out": 4},
      {"kind": "output", "activation": "softmax", "n_out": 2}], (1, 6, 6)),
])
def test_gradients(spec, dims):
    rng = np.random.default_rng(1)
    m = Model.build(spec, dims, seed=3)
    x = rng.normal(size=(5,) + dims)
    y = rng.integers(0, spec[-1]["n_out"], size=5)
    _, grads = nets.loss_and_grads(m.layers, m.params, x, y, l2=0.01)
    for i, p in enumerate(m.params):
        for k in p:
            assert np.allclose(grads[i][k], _num_grad(m.layers, m.params, x, y, 0.01, i, k), atol=1e-6)


def test_frozen_layers_get_no_gradient():
    m = Model.build([{"kind": "dense", "activation": "relu", "n_out": 4, "frozen": True},
                     {"kind": "output", "activation": "softmax", "n_out": 2}], (3,), seed=1)
    _, grads = nets.loss_and_grads(m.layers, m.params, np.ones((2, 3)), np.array([0, 1]))
    assert grads[0] == {} and set(grads[1]) == {"W", "b"}


def test_param_count_of_reference_cnn():
    # conv5x5(20) - pool2 - conv5x5(50) - pool2 - dense 500 relu - softmax 10 on 1x28x28
    spec = [{"kind": "conv", "activation": "identity", "n_out": 20, "kernel": 5, "channels_in": 1},
            {"kind": "pool", "kernel": 2, "stride": 2},
            {"kind": "conv", "activation": "identity", "n_out": 50, "kernel": 5},
            {"kind": "pool", "kernel": 2, "stride": 2},
            {"kind": "dense", "activation": "relu", "n_out": 500},
            {"kind": "output", "activation": "softmax", "n_out": 10}]
    assert Model.build(spec, (1, 28, 28)).n_params() == 431_080


def test_inference_slices_match_whole_batch(spark):
    from tessera.operators import infer
    m = Model.build([{"kind": "conv", "activation": "relu", "n_out": 3, "kernel": 3, "channels_in": 1},
                     {"kind": "pool", "kernel": 2, "stride": 2},
                     {"kind": "output", "activation": "softmax", "n_out": 2}], (1, 8, 8), seed=4)
    rng = np.random.default_rng(0)
    x = rng.normal(size=(50, 64))
    df = spark.createDataFrame([(i, [float(v) for v in x[i]]) for i in range(50)], "k long, features array<double>")
    assert infer._rows_per_slice(m.layers, m.params, (1, 8, 8), None, 200) == 1
    got = {r["k"]: r["scores"] for r in infer.predict(df, m, keep=("k",), max_cells=200).collect()}
    want = nets.forward(m.layers, m.params, x.reshape(50, 1, 8, 8))
    assert all(np.allclose(got[i], want[i]) for i in range(50))
