"""Full-size picture preparation (D1-D6, D11 on 224x224x3 and larger).

Higher-order SQL functions over 150,528-element arrays are interpreted per
element, so for full-size pictures the same steps also run as NumPy on Arrow
batches (``engine="numpy"``). Both engines give the same values; the SQL
engine stays the default for small pictures. Bilinear resizing exists only
here (half-pixel centres, edge clamping, as common image libraries do).
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..dims import IMAGENET_MEAN, IMAGENET_STD
from ..functions import tensors as D

STEPS = ("to_rgb", "resize", "scale_unit", "scale_signed", "standardize", "flip")


# The NumPy steps work on one picture [h, w, c] or a stack [N, h, w, c] alike
# (axes counted from the end).

def _np_to_rgb(img):
    if img.shape[-1] == 1:
        return np.repeat(img, 3, axis=-1)
    return img[..., 2::-1] if img.shape[-1] >= 3 else img


def _np_resize_nearest(img, oh, ow):
    h, w = img.shape[-3], img.shape[-2]
    ys = (np.arange(oh) * h) // oh
    xs = (np.arange(ow) * w) // ow
    return np.take(np.take(img, ys, axis=-3), xs, axis=-2)


def resize_bilinear_array(img: np.ndarray, oh: int, ow: int) -> np.ndarray:
    """Bilinear resize with half-pixel centres and clamped edges."""
    h, w = img.shape[-3], img.shape[-2]
    fy = np.clip((np.arange(oh) + 0.5) * h / oh - 0.5, 0, h - 1)
    fx = np.clip((np.arange(ow) + 0.5) * w / ow - 0.5, 0, w - 1)
    y0, x0 = np.floor(fy).astype(int), np.floor(fx).astype(int)
    y1, x1 = np.minimum(y0 + 1, h - 1), np.minimum(x0 + 1, w - 1)
    wy, wx = (fy - y0)[:, None, None], (fx - x0)[None, :, None]
    rows0, rows1 = np.take(img, y0, axis=-3), np.take(img, y1, axis=-3)
    a, b = np.take(rows0, x0, axis=-2), np.take(rows0, x1, axis=-2)
    c, d = np.take(rows1, x0, axis=-2), np.take(rows1, x1, axis=-2)
    return (a * (1 - wx) + b * wx) * (1 - wy) + (c * (1 - wx) + d * wx) * wy


def _np_step(img, step, size, bilinear):
    if step == "to_rgb":
        return _np_to_rgb(img)
    if step == "resize":
        return resize_bilinear_array(img, *size) if bilinear else _np_resize_nearest(img, *size)
    if step == "scale_unit":
        return img / 255.0
    if step == "scale_signed":
        return img / 127.5 - 1.0
    if step == "standardize":
        c = img.shape[-1]
        mean = np.array(IMAGENET_MEAN)[np.arange(c) % 3]
        std = np.array(IMAGENET_STD)[np.arange(c) % 3]
        return (img / 255.0 - mean) / std
    if step == "flip":
        return img[..., ::-1, :]
    raise ValueError(step)


def prepare_pictures(df: DataFrame, steps: list[str], size: tuple[int, int] | None = None,
                     engine: str = "sql", bilinear: bool = False, px: str = "pixels") -> DataFrame:
    """Apply ``steps`` (in order) to every picture; ``engine`` is ``sql`` or ``numpy``.
    Shape columns are updated by ``to_rgb`` and ``resize``."""
    for s in steps:
        if s not in STEPS:
            raise ValueError(f"unknown step {s}")
    if bilinear and engine != "numpy":
        raise ValueError("bilinear resizing runs with engine='numpy'")
    if engine == "sql":
        out = df
        for s in steps:
            if s == "to_rgb":
                out = out.withColumn(px, D.to_rgb(px, "height", "width", "n_channels")).withColumn(
                    "n_channels", F.lit(3))
            elif s == "resize":
                out = out.withColumn(px, D.resize_nearest(px, "height", "width", "n_channels", *size)).withColumn(
                    "height", F.lit(size[0])).withColumn("width", F.lit(size[1]))
            elif s == "scale_unit":
                out = out.withColumn(px, D.scale_unit(px))
            elif s == "scale_signed":
                out = out.withColumn(px, D.scale_signed(px))
            elif s == "standardize":
                out = out.withColumn(px, D.standardize(px, n_channels="n_channels"))
            elif s == "flip":
                out = out.withColumn(px, D.flip_h(px, "height", "width", "n_channels"))
        return out.withColumn(px, F.col(px).cast("array<double>"))

    cast = df.withColumn(px, F.col(px).cast("array<double>"))

    def run(batches):
        for pdf in batches:
            pdf = pdf.copy()
            n = len(pdf)
            pics, hs, ws, cs = [None] * n, [0] * n, [0] * n, [0] * n
            groups: dict[tuple, list[int]] = {}
            for i, shape in enumerate(zip(pdf["height"], pdf["width"], pdf["n_channels"])):
                groups.setdefault(tuple(int(v) for v in shape), []).append(i)
            for (h, w, c), idx in groups.items():  # one stack per picture shape
                if min(h, w, c) <= 0:  # undecodable: passed through unchanged
                    for i in idx:
                        pics[i], hs[i], ws[i], cs[i] = pdf[px].iat[i], h, w, c
                    continue
                imgs = np.stack([np.asarray(pdf[px].iat[i], dtype=np.float64) for i in idx]).reshape(-1, h, w, c)
                for s in steps:
                    imgs = _np_step(imgs, s, size, bilinear)
                for j, i in enumerate(idx):
                    pics[i] = imgs[j].ravel()
                    hs[i], ws[i], cs[i] = imgs.shape[1:]
            pdf[px], pdf["height"], pdf["width"], pdf["n_channels"] = pics, hs, ws, cs
            yield pdf

    return cast.mapInPandas(run, cast.schema)
