"""Layer maths for one Arrow batch (M8-M10): forward, loss and gradients in
NumPy. Called inside ``mapInPandas`` / ``applyInPandas`` tasks only; Spark
partitions, shuffles and averages the work (see ``train`` and ``infer``).

Layer spec (a dict, one row of the ``model_layers`` table):
  kind: dense | output | conv | pool | flatten
  activation: identity | relu | leakyrelu | sigmoid | tanh | softmax
  n_in, n_out, kernel (conv/pool), stride, channels_in, frozen
Parameters per layer: ``W`` and ``b`` (dense/output/conv), nothing otherwise.
"""

from __future__ import annotations

import numpy as np

# ------------------------------------------------------------ activations


def activate(z: np.ndarray, name: str) -> np.ndarray:
    if name in ("identity", "linear"):
        return z
    if name == "relu":
        return np.maximum(z, 0.0)
    if name == "leakyrelu":
        return np.where(z > 0, z, 0.01 * z)
    if name == "sigmoid":
        return 1.0 / (1.0 + np.exp(-z))
    if name == "tanh":
        return np.tanh(z)
    if name == "softmax":
        m = z.max(axis=1, keepdims=True)
        e = np.exp(z - m)
        return e / e.sum(axis=1, keepdims=True)
    raise ValueError(f"unknown activation {name}")


def activate_grad(z: np.ndarray, a: np.ndarray, name: str, upstream: np.ndarray) -> np.ndarray:
    """dL/dz given dL/da (softmax is only used fused with the NLL loss)."""
    if name in ("identity", "linear"):
        return upstream
    if name == "relu":
        return upstream * (z > 0)
    if name == "leakyrelu":
        return upstream * np.where(z > 0, 1.0, 0.01)
    if name == "sigmoid":
        return upstream * a * (1.0 - a)
    if name == "tanh":
        return upstream * (1.0 - a * a)
    raise ValueError(f"no standalone gradient for {name}")


# ------------------------------------------------------------ conv helpers

def _windows(x: np.ndarray, k: int, s: int) -> np.ndarray:
    """(N, C, H, W) -> (N, C, OH, OW, k, k) strided view, truncating edges."""
    n, c, h, w = x.shape
    oh, ow = (h - k) // s + 1, (w - k) // s + 1
    sn, sc, sh, sw = x.strides
    return np.lib.stride_tricks.as_strided(x, (n, c, oh, ow, k, k), (sn, sc, sh * s, sw * s, sh, sw),
                                           writeable=False)


def _conv_forward(x, W, b, s):
    k = W.shape[2]
    win = _windows(x, k, s)  # N C OH OW k k
    return np.einsum("ncxykl,fckl->nfxy", win, W, optimize=True) + b[None, :, None, None]


def _conv_backward(x, W, s, dz):
    k = W.shape[2]
    win = _windows(x, k, s)
    dW = np.einsum("ncxykl,nfxy->fckl", win, dz, optimize=True)
    db = dz.sum(axis=(0, 2, 3))
    dx = np.zeros_like(x)
    oh, ow = dz.shape[2], dz.shape[3]
    for i in range(k):
        for j in range(k):
            dx[:, :, i:i + s * oh:s, j:j + s * ow:s] += np.einsum("nfxy,fc->ncxy", dz, W[:, :, i, j], optimize=True)
    return dx, dW, db


def _pool_forward(x, k, s):
    win = _windows(x, k, s)
    return win.max(axis=(4, 5))


def _pool_backward(x, k, s, dy):
    win = _windows(x, k, s)
    n, c, oh, ow = dy.shape
    flat = win.reshape(n, c, oh, ow, k * k)
    arg = flat.argmax(axis=4)  # first maximum takes the gradient
    dx = np.zeros_like(x)
    ii, jj = np.divmod(arg, k)
    nn, cc, xx, yy = np.indices((n, c, oh, ow))
    np.add.at(dx, (nn, cc, xx * s + ii, yy * s + jj), dy)
    return dx


# ------------------------------------------------------------ network

def input_shape(layers: list[dict], n_features: int) -> tuple:
    first = layers[0]
    if first["kind"] in ("conv", "pool"):
        c = int(first.get("channels_in") or 1)
        side = int(round((n_features / c) ** 0.5))
        h = int(first.get("height") or side)
        w = n_features // (c * h)
        return (c, h, w)
    return (n_features,)


def forward(layers: list[dict], params: list[dict], x: np.ndarray, upto: int | None = None,
            keep: bool = False):
    """Run layers [0, upto]; returns the output (and the cache when ``keep``)."""
    cache = []
    a = x
    last = len(layers) - 1 if upto is None else upto
    for i, (ly, p) in enumerate(zip(layers, params)):
        if i > last:
            break
        kind = ly["kind"]
        inp = a
        if kind in ("dense", "output"):
            if a.ndim > 2:
                a = a.reshape(a.shape[0], -1)
                inp = a
            z = a @ p["W"].T + p["b"]
            a = activate(z, ly["activation"])
        elif kind == "conv":
            z = _conv_forward(a, p["W"], p["b"], int(ly.get("stride") or 1))
            a = activate(z, ly["activation"])
        elif kind == "pool":
            z = _pool_forward(a, int(ly["kernel"]), int(ly.get("stride") or ly["kernel"]))
            a = z
        elif kind == "flatten":
            z = a.reshape(a.shape[0], -1)
            a = z
        else:
            raise ValueError(f"unknown layer kind {kind}")
        if keep:
            cache.append((inp, z, a))
    return (a, cache) if keep else a


def nll(probs: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Negative log-likelihood per row (probabilities clipped at 1e-15)."""
    return -np.log(np.clip(probs[np.arange(len(y)), y], 1e-15, None))


def loss_and_grads(layers: list[dict], params: list[dict], x: np.ndarray, y: np.ndarray, l2: float = 0.0):
    """Mean NLL (+ 0.5*l2*|W|^2 over trainable weights) and gradients of the
    trainable layers; the last layer must be a softmax output layer."""
    out, cache = forward(layers, params, x, keep=True)
    n = len(y)
    loss = float(nll(out, y).mean())
    grads = [dict() for _ in layers]
    if layers[-1]["activation"] != "softmax":
        raise ValueError("training needs a softmax output layer")
    delta = out.copy()
    delta[np.arange(n), y] -= 1.0
    delta /= n  # dL/dz of the output layer
    for i in range(len(layers) - 1, -1, -1):
        ly, p = layers[i], params[i]
        inp, z, a = cache[i]
        kind = ly["kind"]
        trainable = not ly.get("frozen")
        if kind in ("dense", "output"):
            if i != len(layers) - 1:
                delta = activate_grad(z, a, ly["activation"], delta)
            if trainable:
                grads[i]["W"] = delta.T @ inp + l2 * p["W"]
                grads[i]["b"] = delta.sum(axis=0)
                loss += 0.5 * l2 * float((p["W"] ** 2).sum())
            if i == 0 or all(layers[j].get("frozen") for j in range(i)):
                break
            delta = delta @ p["W"]
            prev_out = cache[i - 1][2]
            delta = delta.reshape(prev_out.shape)
        elif kind == "conv":
            delta = activate_grad(z, a, ly["activation"], delta)
            dx, dW, db = _conv_backward(inp, p["W"], int(ly.get("stride") or 1), delta)
            if trainable:
                grads[i]["W"] = dW + l2 * p["W"]
                grads[i]["b"] = db
                loss += 0.5 * l2 * float((p["W"] ** 2).sum())
            delta = dx
        elif kind == "pool":
            delta = _pool_backward(inp, int(ly["kernel"]), int(ly.get("stride") or ly["kernel"]), delta)
        elif kind == "flatten":
            delta = delta.reshape(inp.shape)
    return loss, grads


# ------------------------------------------------------------ flat parameter vectors

def param_shapes(layers: list[dict], input_dims: tuple) -> list[dict]:
    """Shapes of W/b per layer, following the data shape through the net."""
    shapes = []
    shape = tuple(input_dims)
    for ly in layers:
        kind = ly["kind"]
        if kind in ("dense", "output"):
            n_in = int(np.prod(shape))
            n_out = int(ly["n_out"])
            shapes.append({"W": (n_out, n_in), "b": (n_out,)})
            shape = (n_out,)
        elif kind == "conv":
            c, h, w = shape
            k, s, f = int(ly["kernel"]), int(ly.get("stride") or 1), int(ly["n_out"])
            shapes.append({"W": (f, c, k, k), "b": (f,)})
            shape = (f, (h - k) // s + 1, (w - k) // s + 1)
        elif kind == "pool":
            c, h, w = shape
            k, s = int(ly["kernel"]), int(ly.get("stride") or ly["kernel"])
            shapes.append({})
            shape = (c, (h - k) // s + 1, (w - k) // s + 1)
        elif kind == "flatten":
            shapes.append({})
            shape = (int(np.prod(shape)),)
    return shapes


def flatten_params(params: list[dict]) -> np.ndarray:
    parts = [p[k].ravel() for p in params for k in ("W", "b") if k in p]
    return np.concatenate(parts) if parts else np.zeros(0)


def unflatten_params(vec: np.ndarray, shapes: list[dict]) -> list[dict]:
    out, off = [], 0
    for sh in shapes:
        d = {}
        for k in ("W", "b"):
            if k in sh:
                size = int(np.prod(sh[k]))
                d[k] = vec[off:off + size].reshape(sh[k])
                off += size
        out.append(d)
    return out
