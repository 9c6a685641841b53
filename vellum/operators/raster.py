"""Page kernels on pixel arrays: preprocessing and layout of one page at a time.

They run inside Arrow batches, a page to a row, and never cross a shuffle. Ink is 0, paper 255.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

# --- preprocessing --------------------------------------------------------------------------


def to_gray(rgb: np.ndarray) -> np.ndarray:
    # The luma weights of red, green and blue.
    return np.rint(rgb.astype(np.float64) @ np.array([0.299, 0.587, 0.114])).clip(0, 255).astype(np.uint8)


def equalise_tiles(gray: np.ndarray, clip: float = 2.5, tiles: int = 16) -> np.ndarray:
    """Contrast-limited histogram equalisation; the maps of the four nearest tiles are blended."""
    h, w = gray.shape
    ys, xs = (np.linspace(0, n, min(tiles, n) + 1).astype(int) for n in (h, w))
    maps = np.empty((len(ys) - 1, len(xs) - 1, 256))
    for i in range(len(ys) - 1):
        for j in range(len(xs) - 1):
            tile = gray[ys[i] : ys[i + 1], xs[j] : xs[j + 1]]
            counts = np.bincount(tile.ravel(), minlength=256).astype(float)
            limit = max(1.0, clip * tile.size / 256)
            counts = np.minimum(counts, limit) + np.maximum(counts - limit, 0).sum() / 256
            maps[i, j] = np.cumsum(counts) * 255 / tile.size

    def nearest(edges: np.ndarray, n: int):
        middle = (edges[:-1] + edges[1:] - 1) / 2
        at = np.arange(n)
        low = np.clip(np.searchsorted(middle, at, "right") - 1, 0, len(middle) - 1)
        high = np.minimum(low + 1, len(middle) - 1)
        span = np.where(high > low, middle[high] - middle[low], 1)
        return low, high, np.clip((at - middle[low]) / span, 0, 1)

    y0, y1, fy = nearest(ys, h)
    x0, x1, fx = nearest(xs, w)
    fy, fx = fy[:, None], fx[None, :]
    pick = lambda a, b: maps[a[:, None], b[None, :], gray]
    mixed = (1 - fy) * ((1 - fx) * pick(y0, x0) + fx * pick(y0, x1)) + fy * ((1 - fx) * pick(y1, x0) + fx * pick(y1, x1))
    return np.rint(mixed).clip(0, 255).astype(np.uint8)


def binarise(gray: np.ndarray, window: int = 51, k: float = 0.2) -> np.ndarray:
    """Paper where the pixel is above mean * (1 + k * (deviation / 127.5 - 1)) of its window."""
    if min(gray.shape) < window:
        window = max(3, min(gray.shape) // 2 * 2 + 1)
    r = window // 2
    padded = np.pad(gray.astype(np.float64), r, mode="reflect" if min(gray.shape) > r else "symmetric")

    def window_sum(a: np.ndarray) -> np.ndarray:
        s = np.pad(a.cumsum(0).cumsum(1), ((1, 0), (1, 0)))
        return s[window:, window:] - s[:-window, window:] - s[window:, :-window] + s[:-window, :-window]

    n = window * window
    mean = window_sum(padded) / n
    deviation = np.sqrt(np.maximum(window_sum(padded**2) / n - mean**2, 0))
    return np.where(gray > mean * (1 + k * (deviation / 127.5 - 1)), 255, 0).astype(np.uint8)


def rotate(image: np.ndarray, degrees: float, smooth: bool) -> np.ndarray:
    """Rotate about the centre; what comes from outside is 0, which is ink."""
    h, w = image.shape
    t = np.deg2rad(degrees)
    y, x = np.mgrid[0:h, 0:w].astype(np.float64)
    cy, cx = (h - 1) / 2, (w - 1) / 2
    sx = np.cos(t) * (x - cx) - np.sin(t) * (y - cy) + cx
    sy = np.sin(t) * (x - cx) + np.cos(t) * (y - cy) + cy

    def at(yy: np.ndarray, xx: np.ndarray) -> np.ndarray:
        inside = (yy >= 0) & (yy < h) & (xx >= 0) & (xx < w)
        return np.where(inside, image[yy.clip(0, h - 1), xx.clip(0, w - 1)], 0)

    if not smooth:
        return at(np.rint(sy).astype(int), np.rint(sx).astype(int)).astype(image.dtype)
    y0, x0 = np.floor(sy).astype(int), np.floor(sx).astype(int)
    fy, fx = sy - y0, sx - x0
    out = (1 - fy) * ((1 - fx) * at(y0, x0) + fx * at(y0, x0 + 1)) + fy * ((1 - fx) * at(y0 + 1, x0) + fx * at(y0 + 1, x0 + 1))
    return out.astype(image.dtype)


def skew_angle(binary: np.ndarray) -> float:
    """The angle that makes row-ink counts vary most; the first of equals; 0 for a blank page.

    A coarse search within two degrees, then a fine one around its best.
    """
    step = max(1, binary.shape[0] // 2000)
    small = binary[::step, ::step]

    def score(angle: float) -> float:
        return float(np.var((rotate(small, angle, smooth=False) == 0).sum(axis=1)))

    best = (0.0, 0.0)
    for grid in (lambda c: np.arange(21) * 0.2 - 2.0, lambda c: c - 0.3 + np.arange(13) * 0.05):
        for angle in grid(best[1]):
            found = score(float(angle))
            if found > best[0]:
                best = (found, float(angle))
    return best[1]


def preprocess(rgb: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(gray for recognition, binary for layout), both straightened."""
    gray = equalise_tiles(to_gray(rgb))
    binary = binarise(gray)
    angle = skew_angle(binary)
    if abs(angle) > 0.1:
        gray, binary = rotate(gray, angle, smooth=True), rotate(binary, angle, smooth=False)
    return gray, binary


# --- profiles -------------------------------------------------------------------------------


def ink(binary: np.ndarray, axis: int) -> np.ndarray:
    return (binary == 0).sum(axis=axis).astype(np.int64)


def moving_mean(values: np.ndarray, size: int) -> np.ndarray:
    """Mean over ``size`` positions (even sizes lean left), mirrored at the ends."""
    padded = np.pad(values.astype(np.float64), (size // 2, size - size // 2 - 1), mode="symmetric")
    sums = np.concatenate([[0.0], padded.cumsum()])
    return (sums[size:] - sums[:-size]) / size


def true_runs(mask: np.ndarray) -> np.ndarray:
    """(start, end) of the runs of True."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], mask.astype(np.int8), [0]])))
    return edges.reshape(-1, 2)


def peaks(v: np.ndarray, height: float, distance: int, prominence: float, width: float) -> list[tuple[int, float]]:
    """(position, prominence) of the peaks of a signal.

    A peak is a plateau higher than both sides, at its middle. Of two closer than ``distance``
    the lower goes. Prominence is the drop to the higher of the lowest points on either side
    before higher ground; width is measured at half of it.
    """
    change = np.flatnonzero(np.diff(v)) + 1
    starts, ends = np.concatenate([[0], change]), np.concatenate([change, [len(v)]])
    level = v[starts]
    top = np.flatnonzero((level[1:-1] > level[:-2]) & (level[1:-1] > level[2:])) + 1 if len(level) > 2 else []
    found = [int((starts[i] + ends[i] - 1) // 2) for i in top]
    found = [p for p in found if v[p] >= height]
    kept: list[int] = []
    for p in sorted(found, key=lambda p: (v[p], p), reverse=True):
        if all(abs(p - q) >= max(1, distance) for q in kept):
            kept.append(p)
    out = []
    for p in sorted(kept):
        higher = np.flatnonzero(v > v[p])
        left = higher[higher < p].max(initial=-1) + 1
        right = higher[higher > p].min(initial=len(v))
        drop = float(v[p] - max(v[left : p + 1].min(), v[p:right].min()))
        if drop >= prominence and _width(v, p, drop) >= width:
            out.append((p, drop))
    return out


def _width(v: np.ndarray, p: int, drop: float) -> float:
    line = v[p] - drop / 2
    below = np.flatnonzero(v < line)
    a, b = below[below < p].max(initial=-1), below[below > p].min(initial=len(v))
    left = a + (line - v[a]) / (v[a + 1] - v[a]) if a >= 0 else 0.0
    right = b - (line - v[b]) / (v[b - 1] - v[b]) if b < len(v) else len(v) - 1.0
    return right - left


# --- layout ---------------------------------------------------------------------------------


@dataclass(frozen=True)
class Region:
    x: int
    width: int
    y_start: int
    y_end: int
    index: int = 0


def content_box(binary: np.ndarray, margin: int = 20) -> tuple[int, int, int, int]:
    """(top, bottom, left, right) around the ink, or the whole page."""
    h, w = binary.shape
    sides = []
    for axis, size in ((1, h), (0, w)):
        counts = ink(binary, axis)
        at = np.flatnonzero(counts > max(counts.max(initial=0) * 0.005, 1))
        if not len(at):
            return 0, h, 0, w
        sides += [max(0, int(at[0]) - margin), min(size, int(at[-1]) + margin)]
    return tuple(sides)


def header_end(binary: np.ndarray) -> int:
    """Where the masthead ends: behind the longest quiet run in the top quarter."""
    h = binary.shape[0]
    quarter = moving_mean(ink(binary, 1), max(20, h // 200))[: h // 4]
    if len(quarter) >= 10:
        quiet = true_runs(quarter < max(np.median(quarter) * 0.08, 1))
        length = quiet[:, 1] - quiet[:, 0]
        fits = (quiet[:, 1] > h // 20) & (length >= max(10, h // 300))
        if fits.any():
            return int(quiet[np.argmax(np.where(fits, length, -1)), 1])
    return h // 12


def ruled_lines(binary: np.ndarray, y: int) -> list[int]:
    """Positions of vertical rules: thin connected strokes of a third of the height."""
    region = binary[y:]
    h, w = region.shape
    if h < 100 or w < 100:
        return []
    least = h // 3
    strokes = [(x, int(a), int(b)) for x in range(w) for a, b in true_runs(region[:, x] != 255) if b - a >= least]
    parent = list(range(len(strokes)))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    by_x: dict[int, list[int]] = {}
    for i, (x, _, _) in enumerate(strokes):
        by_x.setdefault(x, []).append(i)
    for i, (x, a, b) in enumerate(strokes):
        for j in by_x.get(x - 1, []):
            # touching by an edge or a corner
            if strokes[j][1] <= b and a <= strokes[j][2]:
                parent[root(i)] = root(j)
    groups: dict[int, list[tuple[int, int, int]]] = {}
    for i, stroke in enumerate(strokes):
        groups.setdefault(root(i), []).append(stroke)
    out = []
    for group in groups.values():
        xs = [x for x, _, _ in group]
        wide, tall = max(xs) - min(xs) + 1, max(b for _, _, b in group) - min(a for _, a, _ in group)
        if wide <= 10 and tall >= least and tall / wide > 15:
            out.append(int(sum(x * (b - a) for x, a, b in group) / sum(b - a for _, a, b in group)))
    return sorted(out)


# What makes a gutter (of the inverted, normalised profile), and how wide its smoothing is.
GUTTER_HEIGHT, GUTTER_PROMINENCE, GUTTER_WIDTH = 0.55, 0.15, 2
GUTTER_SPACING, GUTTER_MARGIN = 0.06, 25
SMOOTH_LEAST, SMOOTH_PART = 15, 200
#: Regions smaller than this on a side have neither rules nor gutters.
LEAST_SIDE = 100
# How columns are made of marks.
MOST_COLUMNS, SPLIT_COLUMNS, SPLIT_SPACING, SPLIT_FACTOR = 8, 4, 0.15, 1.7
MARK_TOLERANCE, LEAST_COLUMN, EQUAL_COLUMNS = 0.02, 0.07, 6
COLUMN_PAD, COLUMN_PAD_PART = 8, 20


def gutter_peaks(profile: np.ndarray, spacing: float = GUTTER_SPACING) -> list[tuple[int, float]]:
    """(position, prominence) of the quiet places in a profile of ink by column of pixels."""
    width = len(profile)
    smooth = moving_mean(profile, max(SMOOTH_LEAST, width // SMOOTH_PART))
    top = smooth.max(initial=0)
    return [] if top < 1 else peaks(1 - smooth / top, GUTTER_HEIGHT, int(width * spacing), GUTTER_PROMINENCE, GUTTER_WIDTH)


def most_prominent(found: list[tuple[int, float]], width: int, most: int, compat: bool = False) -> list[int]:
    """Positions off both edges; of too many, the most prominent, from left to right.

    ``compat`` reads the prominences off the list as it was before those at the edges went, so
    that a peak may be judged by another's.
    """
    margin = width // GUTTER_MARGIN
    inner = [peak for peak in found if margin < peak[0] < width - margin]
    if len(inner) <= most:
        return [at for at, _ in inner]
    judged = zip(inner, found if compat else inner)
    ranked = sorted(((drop, -i, at) for i, ((at, _), (_, drop)) in enumerate(judged)), reverse=True)
    return sorted(at for _, _, at in ranked[:most])


def gutters(binary: np.ndarray, y: int, spacing: float = GUTTER_SPACING, most_columns: int = MOST_COLUMNS, compat: bool = False) -> list[int]:
    """Positions of the white gutters below row y, fewer than ``most_columns``."""
    region = binary[y:]
    if min(region.shape) < LEAST_SIDE:
        return []
    return most_prominent(gutter_peaks(ink(region, 0), spacing), region.shape[1], most_columns - 1, compat)


def thinned(marks: list[int], tolerance: float) -> list[int]:
    """Marks that lie farther than the tolerance from the last one kept."""
    kept: list[int] = []
    for mark in sorted(set(marks)):
        if not kept or mark - kept[-1] > tolerance:
            kept.append(mark)
    return kept


def strips(edges: list[int], least: float) -> list[tuple[int, int]]:
    """(x, width) between neighbouring edges: narrow ones go, the rest lose a pad on both sides."""
    spans = [(a, b - a) for a, b in zip(edges, edges[1:]) if b - a >= least]
    pads = [min(COLUMN_PAD, width // COLUMN_PAD_PART) for _, width in spans]
    return [(a + pad, width - 2 * pad) for (a, width), pad in zip(spans, pads)]


def split_wide(found: list[tuple[int, int]], inside) -> list[tuple[int, int]]:
    """Each strip much wider than the middle one replaced by what ``inside`` parts it into, if
    that parts it at all."""
    if len(found) < 2:
        return found
    limit = sorted(width for _, width in found)[len(found) // 2] * SPLIT_FACTOR
    out: list[tuple[int, int]] = []
    for strip in found:
        parts = inside(*strip) if strip[1] > limit else None
        out += [strip] if parts is None else parts
    return out


def segment_columns(binary: np.ndarray, most_columns: int = MOST_COLUMNS) -> tuple[Region, list[Region]]:
    """The header and the columns of a page.

    Inside the content box, below the header, rules and gutters mark where columns part; without
    any mark the box is cut into equal columns.
    """
    top, bottom, left, right = content_box(binary)
    page, wide = binary[top:bottom, left:right], right - left
    body = header_end(page)
    least = wide * LEAST_COLUMN
    marks = thinned(ruled_lines(page, body) + gutters(page, body, GUTTER_SPACING, most_columns), wide * MARK_TOLERANCE)
    equal = [wide // EQUAL_COLUMNS * i for i in range(1, EQUAL_COLUMNS)]

    def inside(x: int, width: int) -> list[tuple[int, int]] | None:
        cuts = gutters(page[body:, x : x + width], 0, SPLIT_SPACING, SPLIT_COLUMNS)
        return [(x + a, w) for a, w in strips([0, *cuts, width], least)] if cuts else None

    found = split_wide(strips([0, *(marks or equal), wide], least), inside)
    columns = [Region(left + x, w, top + body, bottom, i) for i, (x, w) in enumerate(found)]
    return Region(left, wide, top, top + body), columns


def segment_blocks(column: np.ndarray, min_gap: int = 25) -> list[tuple[int, int]]:
    """Text blocks of a column, parted by white gaps."""
    h = column.shape[0]
    smooth = moving_mean(ink(column, 1), 5) if h >= 30 else np.zeros(1)
    if h < 30 or smooth.max() < 1:
        return [(0, h)]
    out, start = [], 0
    for a, b in true_runs(smooth < smooth.max() * 0.02):
        if b < h and b - a >= min_gap and a > start + 20:
            out.append((start, int(a)))
            start = int(b)
    if h > start + 20:
        out.append((start, h))
    return out or [(0, h)]
