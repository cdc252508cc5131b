"""Well-known text and planar rings, in plain Python for use inside Arrow batches."""

from __future__ import annotations

import math
import re
from fractions import Fraction

Point = tuple[float, float]
Ring = list[Point]

_SHAPE = re.compile(r"^\s*(?:SRID\s*=\s*\d+\s*;)?\s*(MULTIPOLYGON|POLYGON)\s*(?:ZM|Z|M)?\s*(.*)$", re.IGNORECASE | re.DOTALL)
_RING = re.compile(r"\(([^()]*)\)")


def parse_polygons(text: str | None) -> list[list[Ring]]:
    """Polygons, each a list of rings (outer first); none for null, empty or unreadable text."""
    found = _SHAPE.match(text or "")
    if not found or "(" not in found[2]:
        return []
    kind, body = found[1].upper(), found[2].strip()
    parts = _split(body[1 : body.rfind(")")]) if kind == "MULTIPOLYGON" else [body]
    polygons = []
    for part in parts:
        rings = [ring for ring in map(_ring, _RING.findall(part)) if len(ring) >= 3]
        if rings:
            polygons.append(rings)
    return polygons


def _split(body: str) -> list[str]:
    parts, depth, start = [], 0, 0
    for at, sign in enumerate(body):
        if sign == "(":
            if depth == 0:
                start = at
            depth += 1
        elif sign == ")":
            depth -= 1
            if depth == 0:
                parts.append(body[start : at + 1])
    return parts


def _ring(text: str) -> Ring:
    points: Ring = []
    for pair in text.split(","):
        numbers = pair.split()
        try:
            point = (float(numbers[0]), float(numbers[1]))
        except (IndexError, ValueError):
            continue
        if all(map(math.isfinite, point)) and (not points or point != points[-1]):
            points.append(point)
    if len(points) > 1 and points[0] == points[-1]:
        points.pop()
    return points


def orientation(a: Point, b: Point, c: Point) -> int:
    """1 where a, b, c turn left, -1 right, 0 on a line; exact for doubles."""
    left, right = (a[0] - c[0]) * (b[1] - c[1]), (a[1] - c[1]) * (b[0] - c[0])
    det = left - right
    if abs(det) > 4e-16 * (abs(left) + abs(right)):
        return 1 if det > 0 else -1
    ax, ay, bx, by, cx, cy = map(Fraction, (*a, *b, *c))
    exact = (ax - cx) * (by - cy) - (ay - cy) * (bx - cx)
    return (exact > 0) - (exact < 0)


def signed_area(ring: Ring) -> float:
    x0, y0 = ring[0]
    return sum((p[0] - x0) * (q[1] - y0) - (q[0] - x0) * (p[1] - y0) for p, q in zip(ring, ring[1:] + ring[:1])) / 2


def _in_triangle(p: Point, a: Point, b: Point, c: Point) -> bool:
    return orientation(a, b, p) >= 0 and orientation(b, c, p) >= 0 and orientation(c, a, p) >= 0


def _crosses(p: Point, q: Point, a: Point, b: Point) -> bool:
    """Segments p-q and a-b meet at a point that is no shared end."""
    if {p, q} & {a, b}:
        return False
    d1, d2, d3, d4 = orientation(p, q, a), orientation(p, q, b), orientation(a, b, p), orientation(a, b, q)
    return d1 * d2 <= 0 and d3 * d4 <= 0 and not (d1 == d2 == d3 == d4 == 0)


def _join_hole(outer: Ring, hole: Ring) -> Ring:
    """The outer ring with the hole cut into it along a bridge that crosses no edge."""
    edges = list(zip(outer, outer[1:] + outer[:1])) + list(zip(hole, hole[1:] + hole[:1]))
    choices = sorted((math.dist(o, h), i, j) for i, o in enumerate(outer) for j, h in enumerate(hole))
    for _, i, j in choices:
        o, h = outer[i], hole[j]
        if not any(_crosses(o, h, a, b) for a, b in edges):
            break
    else:
        raise ValueError("no bridge to a hole")
    return outer[: i + 1] + hole[j:] + hole[: j + 1] + outer[i:]


def triangulate(rings: list[Ring]) -> list[tuple[Point, Point, Point]]:
    """Counter-clockwise triangles that cover the polygon, by ear clipping; ValueError for a ring that crosses itself."""
    outer = rings[0] if signed_area(rings[0]) > 0 else rings[0][::-1]
    holes = [h if signed_area(h) < 0 else h[::-1] for h in rings[1:]]
    want = signed_area(outer) + sum(map(signed_area, holes))
    for hole in sorted(holes, key=lambda h: -max(h)[0]):
        outer = _join_hole(outer, hole)
    chain, out = list(outer), []
    while len(chain) > 3:
        for i in range(len(chain)):
            a, b, c = chain[i - 1], chain[i], chain[(i + 1) % len(chain)]
            turn = orientation(a, b, c)
            if turn < 0:
                continue
            if turn == 0:
                if (b[0] - a[0]) * (c[0] - b[0]) + (b[1] - a[1]) * (c[1] - b[1]) >= 0:
                    del chain[i]
                    break
                continue
            if not any(p not in (a, b, c) and _in_triangle(p, a, b, c) for p in chain):
                out.append((a, b, c))
                del chain[i]
                break
        else:
            raise ValueError("no ear left")
    if len(chain) == 3 and orientation(*chain) > 0:
        out.append(tuple(chain))
    if abs(sum(signed_area(list(t)) for t in out) - want) > 1e-9 * max(1.0, abs(want)):
        raise ValueError("triangles don't add up to the polygon")
    return out
