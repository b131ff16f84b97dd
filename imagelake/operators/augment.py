"""Seeded data augmentation.

Random parameters are derived from ``md5(key:variant:seed:slot)`` instead of
``rand()``, so a retried task draws exactly the same values and the training
table is reproducible. Flip and brightness/contrast are column expressions;
the affine warp and the HSV shift need per-picture index maps and run in
``mapInPandas`` with NumPy: within each Arrow batch, pictures of one shape are
transformed together as one stacked array.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.tensors import brightness_contrast, flip_h

# fixed values: the augmentation recipe (probability and limits per transform).
RECIPE = {
    "flip_p": 0.5,
    "rotate_p": 0.7, "rotate_limit": 15.0,
    "brightness_contrast_p": 0.5, "brightness_limit": 0.2, "contrast_limit": 0.2,
    "hsv_p": 0.5, "hue_limit": 10.0, "sat_limit": 20.0, "val_limit": 10.0,
}
# fixed values: the generator-style recipe (rotation, shifts, zoom, shear, flip).
GENERATOR_RECIPE = {
    "rotation_range": 30.0, "zoom_range": 0.15, "width_shift_range": 0.2,
    "height_shift_range": 0.2, "shear_range": 0.15, "horizontal_flip": True,
}

SLOTS = ["flip", "rotate_on", "rotate", "bc_on", "brightness", "contrast", "hsv_on", "hue", "sat", "val"]


def uniform(key: Column, variant: Column, seed: int, slot: str) -> Column:
    """Deterministic U[0, 1) from the first 32 bits of ``md5(key:variant:seed:slot)``."""
    h = F.md5(F.concat_ws(":", key.cast("string"), variant.cast("string"), F.lit(str(seed)), F.lit(slot)))
    return F.conv(F.substring(h, 1, 8), 16, 10).cast("double") / 4294967296.0


def augment_params(df: DataFrame, n: int, seed: int = 0, key_col: str = "vec_id",
                   split_col: str | None = "split", recipe: dict | None = None) -> DataFrame:
    """``n`` variants per training row (D15) with their parameters: ``flip`` (bool),
    ``angle`` (degrees, 0 when off), ``brightness``, ``contrast`` (0 when off),
    ``hue``, ``sat``, ``val`` (0 when off)."""
    r = {**RECIPE, **(recipe or {})}
    src = df.where(F.col(split_col) == "train") if split_col else df
    v = src.withColumn("variant", F.explode(F.sequence(F.lit(1), F.lit(n))))
    u = {s: uniform(F.col(key_col), F.col("variant"), seed, s) for s in SLOTS}
    sym = lambda s, lim: (u[s] * 2 - 1) * lim
    on = lambda s, p: u[s] < p
    return (v.withColumn("flip", on("flip", r["flip_p"]))
             .withColumn("angle", F.when(on("rotate_on", r["rotate_p"]), sym("rotate", r["rotate_limit"]))
                         .otherwise(F.lit(0.0)))
             .withColumn("brightness", F.when(on("bc_on", r["brightness_contrast_p"]),
                                              sym("brightness", r["brightness_limit"])).otherwise(F.lit(0.0)))
             .withColumn("contrast", F.when(on("bc_on", r["brightness_contrast_p"]),
                                            sym("contrast", r["contrast_limit"])).otherwise(F.lit(0.0)))
             .withColumn("hue", F.when(on("hsv_on", r["hsv_p"]), sym("hue", r["hue_limit"])).otherwise(F.lit(0.0)))
             .withColumn("sat", F.when(on("hsv_on", r["hsv_p"]), sym("sat", r["sat_limit"])).otherwise(F.lit(0.0)))
             .withColumn("val", F.when(on("hsv_on", r["hsv_p"]), sym("val", r["val_limit"])).otherwise(F.lit(0.0))))


GEN_SLOTS = ["g_flip", "g_rotate", "g_shift_x", "g_shift_y", "g_zoom_x", "g_zoom_y", "g_shear"]


def generator_params(df: DataFrame, n: int, seed: int = 0, key_col: str = "vec_id",
                     split_col: str | None = "split", recipe: dict | None = None) -> DataFrame:
    """``n`` variants per training row with generator-style parameters (D13):
    ``angle`` in [-rotation, rotation] degrees, ``shift_x``/``shift_y`` in
    [-range, range] of the size, ``zoom_x``/``zoom_y`` in [1 - zoom, 1 + zoom],
    ``shear`` in [-shear, shear] degrees and ``flip`` with probability 1/2."""
    r = {**GENERATOR_RECIPE, **(recipe or {})}
    src = df.where(F.col(split_col) == "train") if split_col else df
    v = src.withColumn("variant", F.explode(F.sequence(F.lit(1), F.lit(n))))
    u = {s: uniform(F.col(key_col), F.col("variant"), seed, s) for s in GEN_SLOTS}
    sym = lambda s, lim: (u[s] * 2 - 1) * lim
    flip = (u["g_flip"] < 0.5) if r["horizontal_flip"] else F.lit(False)
    return (v.withColumn("flip", flip)
             .withColumn("angle", sym("g_rotate", r["rotation_range"]))
             .withColumn("shift_x", sym("g_shift_x", r["width_shift_range"]))
             .withColumn("shift_y", sym("g_shift_y", r["height_shift_range"]))
             .withColumn("zoom_x", 1 + sym("g_zoom_x", r["zoom_range"]))
             .withColumn("zoom_y", 1 + sym("g_zoom_y", r["zoom_range"]))
             .withColumn("shear", sym("g_shear", r["shear_range"])))


def apply_flip_bc(params: DataFrame, px: str = "pixels") -> DataFrame:
    """Column-expression part of a variant: flip, then brightness/contrast."""
    flipped = F.when(F.col("flip"), flip_h(px, "height", "width", "n_channels")).otherwise(F.col(px))
    return params.withColumn(px, brightness_contrast(flipped, F.col("brightness"), F.col("contrast")))


# --- NumPy transforms (per Arrow batch) ---------------------------------------

def affine_matrix(angle_deg: float, shift_x: float, shift_y: float, zoom_x: float, zoom_y: float,
                  shear_deg: float, h: int, w: int) -> np.ndarray:
    """3x3 output->source map about the picture centre (shifts are fractions of size)."""
    a, s = np.deg2rad(angle_deg), np.deg2rad(shear_deg)
    rot = np.array([[np.cos(a), -np.sin(a), 0], [np.sin(a), np.cos(a), 0], [0, 0, 1]])
    shear = np.array([[1, -np.sin(s), 0], [0, np.cos(s), 0], [0, 0, 1]])
    zoom = np.array([[zoom_y, 0, 0], [0, zoom_x, 0], [0, 0, 1]])
    shift = np.array([[1, 0, shift_y * h], [0, 1, shift_x * w], [0, 0, 1]])
    m = shift @ rot @ shear @ zoom
    cy, cx = (h - 1) / 2.0, (w - 1) / 2.0
    to_c = np.array([[1, 0, cy], [0, 1, cx], [0, 0, 1]])
    from_c = np.array([[1, 0, -cy], [0, 1, -cx], [0, 0, 1]])
    return to_c @ m @ from_c


def warp(img: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Apply an output->source map with nearest sampling and edge ('nearest') fill."""
    h, w = img.shape[:2]
    yy, xx = np.meshgrid(np.arange(h), np.arange(w), indexing="ij")
    pts = np.stack([yy.ravel(), xx.ravel(), np.ones(h * w)])
    sy, sx = (m @ pts)[:2]
    sy = np.clip(np.rint(sy), 0, h - 1).astype(int)
    sx = np.clip(np.rint(sx), 0, w - 1).astype(int)
    return img[sy, sx].reshape(img.shape)


def rgb_to_hsv(rgb: np.ndarray) -> np.ndarray:
    """[0, 255] RGB -> H in degrees [0, 360), S and V in [0, 255] (vectorised)."""
    x = rgb.astype(np.float64) / 255.0
    r, g, b = x[..., 0], x[..., 1], x[..., 2]
    v = x.max(axis=-1)
    c = v - x.min(axis=-1)
    s = np.where(v > 0, c / np.where(v > 0, v, 1), 0.0)
    safe = np.where(c > 0, c, 1)
    h = np.where(v == r, ((g - b) / safe) % 6, np.where(v == g, (b - r) / safe + 2, (r - g) / safe + 4))
    h = np.where(c > 0, h * 60.0, 0.0)
    return np.stack([h, s * 255.0, v * 255.0], axis=-1)


def hsv_to_rgb(hsv: np.ndarray) -> np.ndarray:
    h, s, v = hsv[..., 0] % 360.0, hsv[..., 1] / 255.0, hsv[..., 2] / 255.0
    c = v * s
    hp = h / 60.0
    x = c * (1 - np.abs(hp % 2 - 1))
    z = np.zeros_like(h)
    sector = np.floor(hp).astype(int) % 6
    r = np.choose(sector, [c, x, z, z, x, c])
    g = np.choose(sector, [x, c, c, x, z, z])
    b = np.choose(sector, [z, z, x, c, c, x])
    m = v - c
    return np.stack([r + m, g + m, b + m], axis=-1) * 255.0


def hsv_shift_array(img: np.ndarray, dh: float, ds: float, dv: float) -> np.ndarray:
    """Shift hue (degrees), saturation and value (0-255 units, clipped) of an RGB picture."""
    if (dh == 0 and ds == 0 and dv == 0) or img.shape[-1] != 3:
        return img.astype(np.float64)
    hsv = rgb_to_hsv(img)
    hsv[..., 0] = (hsv[..., 0] + dh) % 360.0
    hsv[..., 1] = np.clip(hsv[..., 1] + ds, 0, 255)
    hsv[..., 2] = np.clip(hsv[..., 2] + dv, 0, 255)
    return np.clip(hsv_to_rgb(hsv), 0, 255)


def warp_batch(imgs: np.ndarray, mats: np.ndarray) -> np.ndarray:
    """``warp`` for a stack of same-shape pictures ``[N, h, w, c]`` with one
    output->source map each (``mats`` ``[N, 3, 3]``)."""
    n, h, w = imgs.shape[:3]
    yy, xx = np.meshgrid(np.arange(h), np.arange(w), indexing="ij")
    pts = np.stack([yy.ravel(), xx.ravel(), np.ones(h * w)])           # [3, h*w]
    src = mats @ pts                                                     # [N, 3, h*w]
    sy = np.clip(np.rint(src[:, 0]), 0, h - 1).astype(int)
    sx = np.clip(np.rint(src[:, 1]), 0, w - 1).astype(int)
    return imgs[np.arange(n)[:, None], sy, sx].reshape(imgs.shape)


def _pictures_batch(df: DataFrame, fn, params: list[str], px: str = "pixels") -> DataFrame:
    """Run ``fn(imgs[N, h, w, c], {param: array[N]}) -> imgs`` over every picture:
    within each Arrow batch, pictures of one shape are transformed as one stack."""
    def run(batches):
        for pdf in batches:
            pdf = pdf.copy()
            out = [None] * len(pdf)
            shapes = list(zip(pdf["height"], pdf["width"], pdf["n_channels"]))
            groups: dict[tuple, list[int]] = {}
            for i, s in enumerate(shapes):
                groups.setdefault(tuple(int(x) for x in s), []).append(i)
            for (h, w, c), idx in groups.items():
                imgs = np.stack([np.asarray(pdf[px].iat[i], dtype=np.float64) for i in idx]).reshape(-1, h, w, c)
                vals = {p: pdf[p].to_numpy()[idx] for p in params}
                res = fn(imgs, vals)
                for j, i in enumerate(idx):
                    out[i] = res[j].ravel()
            pdf[px] = out
            yield pdf

    cast = df.withColumn(px, F.col(px).cast("array<double>"))
    return cast.mapInPandas(run, cast.schema)


def affine(df: DataFrame, angle: str = "angle", shift_x: str | None = None, shift_y: str | None = None,
           zoom_x: str | None = None, zoom_y: str | None = None, shear: str | None = None,
           px: str = "pixels") -> DataFrame:
    """Rotate / shift / zoom / shear every picture by its row's parameters (D13);
    parameters left as None are neutral."""
    cols = {"angle": angle, "shift_x": shift_x, "shift_y": shift_y, "zoom_x": zoom_x, "zoom_y": zoom_y,
            "shear": shear}
    neutral = {"angle": 0.0, "shift_x": 0.0, "shift_y": 0.0, "zoom_x": 1.0, "zoom_y": 1.0, "shear": 0.0}
    used = [c for c in cols.values() if c]

    def fn(imgs, vals):
        n, h, w = imgs.shape[:3]

        def get(name, k):
            col = cols[name]
            v = vals[col][k] if col else None
            return neutral[name] if v is None or v != v else float(v)

        mats = np.stack([affine_matrix(get("angle", k), get("shift_x", k), get("shift_y", k),
                                       get("zoom_x", k), get("zoom_y", k), get("shear", k), h, w)
                         for k in range(n)])
        return warp_batch(imgs, mats)

    return _pictures_batch(df, fn, used, px)


def hsv_shift_batch(imgs: np.ndarray, dh: np.ndarray, ds: np.ndarray, dv: np.ndarray) -> np.ndarray:
    """``hsv_shift_array`` for a stack of RGB pictures with one shift per picture."""
    if imgs.shape[-1] != 3:
        return imgs
    hsv = rgb_to_hsv(imgs)
    b = (slice(None),) + (None,) * (imgs.ndim - 2)
    hsv[..., 0] = (hsv[..., 0] + dh[b]) % 360.0
    hsv[..., 1] = np.clip(hsv[..., 1] + ds[b], 0, 255)
    hsv[..., 2] = np.clip(hsv[..., 2] + dv[b], 0, 255)
    out = np.clip(hsv_to_rgb(hsv), 0, 255)
    keep = (dh == 0) & (ds == 0) & (dv == 0)       # no shift: the picture as it is
    out[keep] = imgs[keep]
    return out


def hsv_shift(df: DataFrame, hue: str = "hue", sat: str = "sat", val: str = "val",
              px: str = "pixels") -> DataFrame:
    """Shift hue, saturation and value of every RGB picture by its row's parameters."""
    def fn(imgs, vals):
        f = lambda c: np.asarray(vals[c], dtype=np.float64)
        return hsv_shift_batch(imgs, f(hue), f(sat), f(val))
    return _pictures_batch(df, fn, [hue, sat, val], px)


def generator_augment(df: DataFrame, n: int, seed: int = 0, key_col: str = "vec_id",
                      split_col: str | None = "split", px: str = "pixels") -> DataFrame:
    """Generator-style variants (D13): optional flip, then one affine map per variant."""
    p = generator_params(df, n, seed, key_col, split_col)
    p = p.withColumn(px, F.when(F.col("flip"), flip_h(px, "height", "width", "n_channels"))
                     .otherwise(F.col(px).cast("array<double>")))
    return affine(p, "angle", "shift_x", "shift_y", "zoom_x", "zoom_y", "shear", px=px)


def augment_dataset(df: DataFrame, n: int, seed: int = 0, key_col: str = "vec_id",
                    split_col: str | None = "split", recipe: dict | None = None,
                    px: str = "pixels") -> DataFrame:
    """``n`` augmented variants of every training picture (D15): flip and
    brightness/contrast as expressions, then rotation and HSV shift (3 channels)."""
    p = apply_flip_bc(augment_params(df, n, seed, key_col, split_col, recipe), px)
    p = affine(p, "angle", px=px)
    return hsv_shift(p, px=px)
