"""Image kernels on numpy arrays: resampling, dense matching, keypoints, robust estimation.  NaN is a missing value."""

from __future__ import annotations

import numpy as np

#: Dense matchers: cost, its window, the two smoothness penalties, directions, left-right limit, speckle size, scales.
MATCHERS = {
    "mgm": ("census", 5, 8.0, 32.0, 8, 1.0, 0, 1),
    "mgm_multi": ("census", 5, 8.0, 32.0, 8, 1.0, 25, 6),
    "sgbm": ("absolute", 3, 8.0, 32.0, 8, 1.0, 25, 1),
    "hirschmuller02": ("absolute", 3, 8.0, 32.0, 4, 1.0, 0, 1),
    "hirschmuller08": ("census", 3, 8.0, 32.0, 8, 1.0, 0, 1),
}


def sample(im: np.ndarray, x: np.ndarray, y: np.ndarray, order: int = 1) -> np.ndarray:
    """im at (x, y): bilinear (order 1) or nearest (0); NaN outside and where a needed pixel is NaN."""
    height, width = im.shape
    if order == 0:
        i, j = np.rint(y).astype(int), np.rint(x).astype(int)
        ok = (i >= 0) & (i < height) & (j >= 0) & (j < width)
        return np.where(ok, im[np.clip(i, 0, height - 1), np.clip(j, 0, width - 1)], np.nan)
    ok = (x >= 0) & (x <= width - 1) & (y >= 0) & (y <= height - 1)
    j, i = np.clip(np.floor(x), 0, max(width - 2, 0)).astype(int), np.clip(np.floor(y), 0, max(height - 2, 0)).astype(int)
    a, b = np.clip(x - j, 0, 1), np.clip(y - i, 0, 1)
    j1, i1 = np.minimum(j + 1, width - 1), np.minimum(i + 1, height - 1)
    out = np.zeros(np.shape(x))
    for w, p, q in (((1 - a) * (1 - b), i, j), (a * (1 - b), i, j1), ((1 - a) * b, i1, j), (a * b, i1, j1)):
        out = out + np.where(w > 0, w * im[p, q], 0.0)
    return np.where(ok, out, np.nan)


def warp(im: np.ndarray, h: np.ndarray, width: int, height: int, order: int = 1) -> np.ndarray:
    """out(x) = im(h^-1 x) on width x height."""
    inv = np.linalg.inv(np.asarray(h, float).reshape(3, 3))
    x, y = np.meshgrid(np.arange(width, dtype=float), np.arange(height, dtype=float))
    w = inv[2, 0] * x + inv[2, 1] * y + inv[2, 2]
    return sample(np.asarray(im, float), (inv[0, 0] * x + inv[0, 1] * y + inv[0, 2]) / w, (inv[1, 0] * x + inv[1, 1] * y + inv[1, 2]) / w, order)


def height_to_grid(height_map: np.ndarray, h: np.ndarray, width: int, height: int) -> np.ndarray:
    """A rectified height map on the original grid: out(x) = map(h x); missing near what is missing (3 x 3 dilation)."""
    bad = ~np.isfinite(height_map)
    grown = bad.copy()
    for i in (-1, 0, 1):
        for j in (-1, 0, 1):
            grown |= np.roll(np.pad(bad, 1), (i, j), (0, 1))[1:-1, 1:-1]
    back = np.linalg.inv(np.asarray(h, float).reshape(3, 3))
    out = warp(np.where(bad, 0.0, height_map), back, width, height)
    hole = warp(grown.astype(float), back, width, height, 0)
    return np.where(np.nan_to_num(hole, nan=1.0) > 0, np.nan, out)


def shifted(im: np.ndarray, dy: int, dx: int) -> np.ndarray:
    out = np.full(im.shape, np.nan)
    height, width = im.shape
    if abs(dy) < height and abs(dx) < width:
        out[max(0, -dy) : height - max(0, dy), max(0, -dx) : width - max(0, dx)] = im[max(0, dy) : height - max(0, -dy), max(0, dx) : width - max(0, -dx)]
    return out


def census(im: np.ndarray, window: int) -> np.ndarray:
    """One bit for each neighbour that is darker than the centre, as booleans in a third axis."""
    r = window // 2
    with np.errstate(invalid="ignore"):
        return np.stack([shifted(im, i, j) < im for i in range(-r, r + 1) for j in range(-r, r + 1) if (i, j) != (0, 0)], axis=2)


def cost_volume(ref: np.ndarray, sec: np.ndarray, low: int, high: int, kind: str, window: int) -> np.ndarray:
    """(rows, columns, disparities) float32; the dearest where either image is missing."""
    count = high - low + 1
    if kind == "census":
        a, b = census(ref, window), census(sec, window)
        worst = float(a.shape[2])
        volume = np.full((*ref.shape, count), worst, np.float32)
        for k in range(count):
            d = low + k
            j0, j1 = max(0, -d), min(ref.shape[1], ref.shape[1] - d)
            if j1 > j0:
                volume[:, j0:j1, k] = (a[:, j0:j1] != b[:, j0 + d : j1 + d]).sum(2)
    else:
        span = float(np.nanpercentile(np.abs(ref - np.nanmean(ref)), 95)) or 1.0
        worst = 24.0
        volume = np.full((*ref.shape, count), worst, np.float32)
        r = window // 2
        for k in range(count):
            diff = np.minimum(np.nan_to_num(np.abs(ref - shifted(sec, 0, low + k)) / span * worst, nan=worst), worst)
            padded = np.pad(diff, r, mode="edge")
            volume[:, :, k] = np.lib.stride_tricks.sliding_window_view(padded, (window, window)).mean((2, 3))
    missing = ~np.isfinite(ref)
    volume[missing] = worst
    for k in range(count):
        volume[:, :, k][~np.isfinite(shifted(sec, 0, low + k))] = worst
    return volume


def aggregate(volume: np.ndarray, p1: float, p2: float, directions: int) -> np.ndarray:
    """Semi-global sums of path costs along 4 or 8 directions."""
    steps = [(0, 1), (0, -1), (1, 0), (-1, 0), (1, 1), (-1, -1), (1, -1), (-1, 1)][:directions]
    total = np.zeros_like(volume)
    height, width, count = volume.shape

    def advance(prev: np.ndarray, cost: np.ndarray) -> np.ndarray:
        """One step for a row of pixels; prev is NaN where a path begins."""
        fresh = np.isnan(prev[:, :1])
        p = np.where(fresh, 0, prev)
        least = p.min(1, keepdims=True)
        up = np.pad(p, ((0, 0), (1, 1)), constant_values=np.inf)
        best = np.minimum(np.minimum(p, least + p2), np.minimum(up[:, :-2], up[:, 2:]) + p1)
        return cost + np.where(fresh, 0, best - least)

    for dy, dx in steps:
        path = np.empty_like(volume)
        if dy == 0:
            order = range(width) if dx > 0 else range(width - 1, -1, -1)
            prev = np.full((height, count), np.nan, np.float32)
            for j in order:
                prev = path[:, j] = advance(prev, volume[:, j])
        else:
            order = range(height) if dy > 0 else range(height - 1, -1, -1)
            prev = np.full((width, count), np.nan, np.float32)
            for i in order:
                if dx:
                    prev = np.roll(prev, dx, axis=0)
                    prev[0 if dx > 0 else -1] = np.nan
                prev = path[i] = advance(prev, volume[i])
        total += path
    return total


def refine(volume: np.ndarray, best: np.ndarray) -> np.ndarray:
    """Sub-pixel offset of the minimum by a symmetric V through its neighbours."""
    last = volume.shape[2] - 1
    take = lambda k: np.take_along_axis(volume, np.clip(k, 0, last)[..., None], 2)[..., 0]
    a, b, c = take(best - 1), take(best), take(best + 1)
    slope = np.maximum(a - b, c - b)
    with np.errstate(all="ignore"):
        shift = np.where(slope > 0, (a - c) / (2 * slope), 0.0)
    return np.where((best > 0) & (best < last), shift, 0.0)


def median3(im: np.ndarray) -> np.ndarray:
    windows = np.lib.stride_tricks.sliding_window_view(np.pad(im, 1, mode="symmetric"), (3, 3)).reshape(*im.shape, 9)
    with np.errstate(all="ignore"):
        import warnings

        with warnings.catch_warnings():
            warnings.simplefilter("ignore")
            return np.where(np.isfinite(im), np.nanmedian(windows, axis=2), np.nan)


def drop_speckles(im: np.ndarray, least: int, tolerance: float = 1.0) -> np.ndarray:
    """NaN for regions (four neighbours, close values) of fewer pixels."""
    from ..operators.morphology import label_pixels

    row, col = np.nonzero(np.isfinite(im))
    if least <= 1 or not len(row):
        return im
    v = im[row, col]
    labels = label_pixels(row, col, np.arange(len(row)), 0, lambda i, j: np.abs(v[i] - v[j]) <= tolerance)
    size = np.bincount(labels, minlength=len(row))[labels]
    out = im.copy()
    out[row[size < least], col[size < least]] = np.nan
    return out


def limited(low: float, high: float, width: int, limit: float | None = None) -> tuple[int, int]:
    """The disparity range, no wider than the image, in whole numbers; raises beyond the limit."""
    from ..operators.estimation import DisparityRangeTooLarge

    if high - low > width:
        centre = (low + high) / 2
        low, high = centre - width / 2, centre + width / 2
    low, high = int(np.floor(low)), int(np.ceil(high))
    if limit is not None and high - low > limit:
        raise DisparityRangeTooLarge(f"{high - low} > {limit}")
    return low, high


def match_dense(ref: np.ndarray, sec: np.ndarray, low: float, high: float, algorithm: str = "mgm", limit: float | None = None, multiplier: float = 1.0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Disparity (x2 - x1; NaN where rejected), mask and confidence of two rectified images.

    Census or absolute cost, semi-global aggregation, V refinement, left-right test, 3 x 3 median, speckles out.  The
    scales of a coarse-to-fine matcher bound each pixel's search by the coarser result.
    """
    if algorithm not in MATCHERS:
        raise ValueError(f"unknown matching algorithm {algorithm!r}")
    kind, window, p1, p2, directions, agree, speckle, scales = MATCHERS[algorithm]
    ref, sec = np.asarray(ref, float), np.asarray(sec, float)
    low, high = limited(low, high, ref.shape[1], limit)
    if scales > 1 and min(ref.shape) >= 128 and high - low > 16:
        half = lambda im: np.nanmean(np.stack([im[i : im.shape[0] // 2 * 2 : 2, j : im.shape[1] // 2 * 2 : 2] for i in (0, 1) for j in (0, 1)]), axis=0)
        coarse, _, _ = match_dense(half(ref), half(sec), low / 2, high / 2, algorithm, None, multiplier)
        if np.isfinite(coarse).any():
            low, high = max(low, int(np.floor(2 * np.nanmin(coarse))) - 4), min(high, int(np.ceil(2 * np.nanmax(coarse))) + 4)
    volume = aggregate(cost_volume(ref, sec, low, high, kind, window), p1 * multiplier, p2 * multiplier, directions)
    best = volume.argmin(2)
    disparity = low + best + refine(volume, best)
    # the second image's own answer: the least cost along the diagonal of the volume
    height, width, count = volume.shape
    other = np.full((height, width, count), np.inf, np.float32)
    for k in range(count):
        d = low + k
        j0, j1 = max(0, -d), min(width, width - d)
        if j1 > j0:
            other[:, j0 + d : j1 + d, k] = volume[:, j0:j1, k]
    back = low + other.argmin(2)
    col = np.arange(width)[None, :] + np.rint(disparity).astype(int)
    ok = (col >= 0) & (col < width) & np.isfinite(ref)
    there = np.take_along_axis(back, np.clip(col, 0, width - 1), 1)
    ok &= np.abs(there - disparity) <= agree + 0.5
    ordered = np.partition(volume, 1, axis=2)
    confidence = (1 - ordered[..., 0] / np.maximum(ordered[..., 1], 1e-9)).astype(np.float32)
    out = drop_speckles(median3(np.where(ok, disparity, np.nan)), speckle)
    return out, rejection_mask(out, ref, sec), confidence


def rejection_mask(disparity: np.ndarray, ref: np.ndarray, sec: np.ndarray) -> np.ndarray:
    """Whether disparity, the reference and the second image at column + disparity are all there."""
    x, y = np.meshgrid(np.arange(ref.shape[1], dtype=float), np.arange(ref.shape[0], dtype=float))
    return np.isfinite(disparity) & np.isfinite(ref) & np.isfinite(sample(np.asarray(sec, float), x + np.nan_to_num(disparity, nan=-1e9), y))


def erode(mask: np.ndarray, radius: float) -> np.ndarray:
    """Accepted pixels all of whose disk is accepted, for a radius of 2 or more."""
    from ..operators.masks import disk

    if radius < 2:
        return mask
    out, n = mask.copy(), int(radius)
    padded = np.pad(mask, n, constant_values=True)
    for i, j in disk(radius):
        out &= padded[n + i : n + i + mask.shape[0], n + j : n + j + mask.shape[1]]
    return out


def blur(im: np.ndarray, sigma: float) -> np.ndarray:
    r = max(1, int(3 * sigma + 0.5))
    k = np.exp(-0.5 * (np.arange(-r, r + 1) / sigma) ** 2)
    k /= k.sum()
    rows = np.pad(im, ((r, r), (0, 0)), mode="symmetric")
    im = sum(w * rows[i : i + im.shape[0]] for i, w in enumerate(k))
    cols = np.pad(im, ((0, 0), (r, r)), mode="symmetric")
    return sum(w * cols[:, i : i + im.shape[1]] for i, w in enumerate(k))


def keypoints(im: np.ndarray, threshold: float = 0.0133, octaves: int = 8, scales: int = 3, most: int | None = None, origin: tuple[float, float] = (0.0, 0.0)) -> np.ndarray:
    """(n, 132): x, y, scale, orientation and 128 descriptor values of scale-space extrema of differences of Gaussians.

    Detection order is octave, scale, row, column; `most` keeps the first.
    """
    im = np.nan_to_num(np.asarray(im, float), nan=0.0)
    span = im.max() - im.min()
    now = (im - im.min()) / span if span > 0 else np.zeros_like(im)
    found, factor, sigma0 = [], 1.0, 1.6
    k = 2 ** (1 / scales)
    now = blur(now, (sigma0**2 - 0.25) ** 0.5)
    for _ in range(octaves):
        if min(now.shape) < 16:
            break
        stack = [now]
        for s in range(1, scales + 3):
            stack.append(blur(stack[-1], sigma0 * k ** (s - 1) * (k * k - 1) ** 0.5))
        dog = np.stack([b - a for a, b in zip(stack[:-1], stack[1:], strict=True)])
        cubes = np.lib.stride_tricks.sliding_window_view(dog, (3, 3, 3)).reshape(dog.shape[0] - 2, dog.shape[1] - 2, dog.shape[2] - 2, 27)
        centre = dog[1:-1, 1:-1, 1:-1]
        peak = (np.abs(centre) > threshold) & ((centre >= cubes.max(3)) | (centre <= cubes.min(3)))
        for s, i, j in np.argwhere(peak):
            s, i, j = s + 1, i + 1, j + 1
            d = dog[s]
            xx, yy, xy = d[i, j + 1] + d[i, j - 1] - 2 * d[i, j], d[i + 1, j] + d[i - 1, j] - 2 * d[i, j], (d[i + 1, j + 1] - d[i + 1, j - 1] - d[i - 1, j + 1] + d[i - 1, j - 1]) / 4
            det = xx * yy - xy * xy
            if det <= 0 or (xx + yy) ** 2 / det > 12.1:
                continue
            gx, gy = (d[i, j + 1] - d[i, j - 1]) / 2, (d[i + 1, j] - d[i - 1, j]) / 2
            dx, dy = np.clip([-(gx * yy - gy * xy) / det, -(gy * xx - gx * xy) / det], -0.5, 0.5)
            scale = sigma0 * k**s
            for angle, desc in _describe(stack[s], i, j, scale):
                found.append([(j + dx) * factor + origin[0], (i + dy) * factor + origin[1], scale * factor, angle, *desc])
                if most and len(found) >= most:
                    return np.array(found)
        now, factor = stack[scales][::2, ::2], factor * 2
    return np.array(found).reshape(-1, 132)


def _describe(im: np.ndarray, i: int, j: int, scale: float) -> list[tuple[float, np.ndarray]]:
    """(orientation, 4 x 4 x 8 gradient histogram) for each strong orientation; none too near the border."""
    r = int(round(6 * scale))
    if i - r - 1 < 0 or j - r - 1 < 0 or i + r + 2 > im.shape[0] or j + r + 2 > im.shape[1]:
        return []
    patch = im[i - r - 1 : i + r + 2, j - r - 1 : j + r + 2]
    gx, gy = (patch[1:-1, 2:] - patch[1:-1, :-2]) / 2, (patch[2:, 1:-1] - patch[:-2, 1:-1]) / 2
    y, x = np.mgrid[-r : r + 1, -r : r + 1].astype(float)
    size, direction = np.hypot(gx, gy), np.arctan2(gy, gx)
    weight = size * np.exp(-(x * x + y * y) / (2 * (1.5 * scale) ** 2))
    bins = ((direction + np.pi) / (2 * np.pi) * 36).astype(int) % 36
    hist = np.bincount(bins.ravel(), weight.ravel(), 36)
    for _ in range(6):
        hist = (np.roll(hist, 1) + hist + np.roll(hist, -1)) / 3
    out = []
    for b in np.flatnonzero((hist >= 0.8 * hist.max()) & (hist > np.roll(hist, 1)) & (hist > np.roll(hist, -1))):
        angle = (b + 0.5) / 36 * 2 * np.pi - np.pi
        c, s = np.cos(angle), np.sin(angle)
        u, v = (c * x + s * y) / (3 * scale) + 1.5, (-s * x + c * y) / (3 * scale) + 1.5
        turned = ((direction - angle) % (2 * np.pi)) / (2 * np.pi) * 8
        w = size * np.exp(-((u - 1.5) ** 2 + (v - 1.5) ** 2) / 8)
        desc = np.zeros((4, 4, 8))
        for p in (0, 1):
            for q in (0, 1):
                for t in (0, 1):
                    bu, bv, bt = np.floor(u).astype(int) + p, np.floor(v).astype(int) + q, np.floor(turned).astype(int) + t
                    share = (1 - np.abs(u - bu)) * (1 - np.abs(v - bv)) * (1 - np.abs(turned - bt))
                    ok = (bu >= 0) & (bu < 4) & (bv >= 0) & (bv < 4)
                    np.add.at(desc, (bv[ok], bu[ok], bt[ok] % 8), (w * share)[ok])
        flat = desc.ravel()
        flat = np.minimum(flat / (np.linalg.norm(flat) or 1.0), 0.2)
        out.append((float(angle), np.floor(np.minimum(512 * flat / (np.linalg.norm(flat) or 1.0), 255))))
    return out


def affine_fundamental(m: np.ndarray) -> np.ndarray:
    """(a, b, c, d, e) by the smallest singular vector of the centred matches (x1, y1, x2, y2)."""
    x = m[:, [2, 3, 0, 1]]
    centre = x.mean(0)
    v = np.linalg.svd(x - centre, full_matrices=True)[2][-1]
    lead = v[2] if abs(v[2]) > 1e-12 else v[3]
    v = v * (-1 if lead < 0 else 1)
    return np.array([*v, -v @ centre])


def ransac_fundamental(m: np.ndarray, seed: int, trials: int = 1000, limit: float = 0.3) -> np.ndarray:
    """Inlier mask of matches under an affine fundamental matrix; everything if there are fewer than seven."""
    if len(m) < 7:
        return np.ones(len(m), bool)
    r, best = np.random.default_rng(seed), np.zeros(len(m), bool)
    for _ in range(trials):
        f = affine_fundamental(m[r.choice(len(m), 4, replace=False)])
        n1, n2 = np.hypot(f[2], f[3]), np.hypot(f[0], f[1])
        if n1 < 1e-9 or n2 < 1e-9:
            continue
        res = np.abs(m[:, [2, 3, 0, 1]] @ f[:4] + f[4])
        ok = np.maximum(res / n1, res / n2) < limit
        if ok.sum() > best.sum():
            best = ok
    return best


def inside_rings(rings: list[list[tuple[float, float]]], height: int, width: int) -> np.ndarray:
    """Whether each pixel's centre (whole coordinates) is inside an odd number of rings, row by row."""
    edges = [(a, b) for ring in rings for a, b in zip(ring, [*ring[1:], ring[0]], strict=True) if a[1] != b[1]]
    out = np.zeros((height, width), bool)
    if not edges:
        return out
    (x1, y1), (x2, y2) = (np.array([e[i] for e in edges], float).T for i in (0, 1))
    cols = np.arange(width)
    for row in range(height):
        cut = (y1 <= row) != (y2 <= row)
        at = np.sort(x1[cut] + (row - y1[cut]) * (x2[cut] - x1[cut]) / (y2[cut] - y1[cut]))
        out[row] = np.searchsorted(at, cols, side="right") % 2 == 1
    return out
