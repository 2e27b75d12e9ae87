"""Eigenvalues and eigenvectors of an integer matrix from its exact
characteristic polynomial.

``residues`` gives the polynomial modulo many primes at once (Hessenberg form
by similarity transformations, then the recurrence on leading minors);
``combine`` puts them together by Chinese remaindering. The polynomial of a
symmetric matrix has only real roots, so Descartes' rule is exact: the number
of roots above t is the number of sign changes of p(x + t). ``top_roots``
isolates roots by bisection with that count. ``components`` finds the null
space of A - root by inverse iteration in fixed-point integers.
"""

from __future__ import annotations

import numpy as np

FRACTION = 96  # bits after the point of a root, beyond the size of the largest
WORK = 256  # bits after the point in the inverse iteration


def _is_prime(n: int) -> bool:
    """Miller-Rabin; the bases 2, 3, 5 and 7 decide all n below 3.2e9."""
    if n < 2 or any(n % p == 0 and n != p for p in (2, 3, 5, 7)):
        return False
    d, s = n - 1, 0
    while d % 2 == 0:
        d, s = d // 2, s + 1
    for a in (2, 3, 5, 7):
        x = pow(a, d, n)
        if n == a or x in (1, n - 1):
            continue
        for _ in range(s - 1):
            x = x * x % n
            if x == n - 1:
                break
        else:
            return False
    return True


def primes(bits: int) -> list[int]:
    """The largest primes below 2**31 whose product has more than ``bits`` bits."""
    out, have, n = [], 0, (1 << 31) - 1
    while have <= bits:
        if _is_prime(n):
            out.append(n)
            have += n.bit_length() - 1
        n -= 2
    return out


def coefficient_bits(trace: int, d: int) -> int:
    """Bits that hold any coefficient (and its sign) of the polynomial of a
    positive semidefinite d x d matrix: elementary symmetric functions of its
    roots are largest when all roots are equal, (1 + trace / d) ** d in sum."""
    return d * (2 + trace // d).bit_length() + 2


def _inverse(a: np.ndarray, p: np.ndarray) -> np.ndarray:
    """a ** (p - 2) modulo p, elementwise."""
    out, power, e = np.ones_like(a), a.copy(), p - 2
    while e.any():
        out = np.where(e & 1, out * power % p, out)
        power = power * power % p
        e = e >> 1
    return out


def residues(matrix: list[list[int]], moduli: list[int]) -> np.ndarray:
    """The monic characteristic polynomial modulo each prime, one row per
    prime, lowest coefficient first. All primes go through the steps together."""
    d, p = len(matrix), np.array(moduli, np.int64)
    h = np.array([[[x % m for x in row] for row in matrix] for m in moduli], np.int64)
    p1, p2 = p[:, None], p[:, None, None]
    for c in range(d - 2):
        # A row with an entry in column c below the subdiagonal comes up.
        pivot = c + 1 + (h[:, c + 1 :, c] != 0).argmax(axis=1)
        every = np.arange(len(p))
        up, at = h[every, c + 1].copy(), h[every, pivot].copy()
        h[every, c + 1], h[every, pivot] = at, up
        left, right = h[every, :, c + 1].copy(), h[every, :, pivot].copy()
        h[every, :, c + 1], h[every, :, pivot] = right, left
        u = h[:, c + 2 :, c] * _inverse(h[:, c + 1, c], p)[:, None] % p1
        h[:, c + 2 :, :] = (h[:, c + 2 :, :] - u[:, :, None] * h[:, c + 1, None, :] % p2) % p2
        # Sums of products stay below 2**63 when they are reduced one by one.
        h[:, :, c + 1] = (h[:, :, c + 1] + (h[:, :, c + 2 :] * u[:, None, :] % p2).sum(axis=2)) % p1
    poly = np.zeros((d + 1, len(p), d + 1), np.int64)
    poly[0, :, 0] = 1
    for k in range(1, d + 1):
        q = poly[k - 1]
        new = -h[:, k - 1, k - 1, None] * q % p1
        new[:, 1:] += q[:, :-1]
        run = np.ones(len(p), np.int64)
        for i in range(k - 1, 0, -1):
            run = run * h[:, i, i - 1] % p
            new -= (h[:, i - 1, k - 1] * run % p)[:, None] * poly[i - 1] % p1
        poly[k] = new % p1
    return poly[d]


def combine(moduli: list[int], rows: list[list[int]]) -> list[int]:
    """The integer coefficients, nearest to zero, that have these residues."""
    product, value = 1, [0] * len(rows[0])
    for m, row in zip(moduli, rows):
        inverse = pow(product, -1, m)
        value = [v + product * ((int(r) - v) * inverse % m) for v, r in zip(value, row)]
        product *= m
    return [v - product if 2 * v > product else v for v in value]


def _roots_above(poly: list[int], t: int, shift: int) -> int:
    """Number of roots, with multiplicity, above t / 2**shift."""
    d = len(poly) - 1
    c = [x << (shift * (d - k)) for k, x in enumerate(poly)]  # roots times 2**shift
    for i in range(d):
        for k in range(d - 1, i - 1, -1):
            c[k] += t * c[k + 1]
    signs = [x > 0 for x in c if x]
    return sum(a != b for a, b in zip(signs, signs[1:]))


def top_roots(poly: list[int], count: int) -> list[tuple[int, int, int]]:
    """(root * 2**shift, shift, multiplicity) of the largest positive roots of
    a polynomial whose roots are all real and not negative, until ``count``
    roots are covered. Roots that agree in ``FRACTION`` bits below the largest
    root's leading bit count as one."""
    d = len(poly) - 1
    top = -poly[d - 1]  # the trace bounds every root
    shift = max(0, FRACTION - max(1, top).bit_length())
    zeros = next(k for k, x in enumerate(poly) if x)
    count = min(count, d - zeros)
    out, covered = [], 0
    known = {0: d - zeros, top << shift: 0}

    def above(t: int) -> int:
        if t not in known:
            known[t] = _roots_above(poly, t, shift)
        return known[t]

    width = max(1, (top << shift) >> FRACTION)
    while covered < count:
        # The largest t with more than ``covered`` roots above it.
        lo = max(t for t, n in known.items() if n > covered)
        hi = min(t for t, n in known.items() if n <= covered)
        while hi - lo > width:
            mid = (lo + hi) // 2
            if above(mid) > covered:
                lo = mid
            else:
                hi = mid
        out.append((hi, shift, above(lo) - covered))
        covered = above(lo)
    return out


def _solve(matrix: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Solve in fixed-point integers (object arrays, WORK bits after the
    point), partial pivoting; a pivot of zero counts as one unit."""
    a = np.concatenate([matrix, right], axis=1)
    d = len(matrix)
    for c in range(d):
        at = c + int(np.argmax([abs(x) for x in a[c:, c]]))
        if at != c:
            a[[c, at]] = a[[at, c]]
        if a[c, c] == 0:
            a[c, c] = 1
        factor = (a[c + 1 :, c] << WORK) // a[c, c]
        a[c + 1 :, c:] -= (factor[:, None] * a[c, c:][None, :]) >> WORK
    x = a[:, d:].copy()
    for c in range(d - 1, -1, -1):
        x[c] = [(v << WORK) // a[c, c] for v in x[c] - ((a[c, c + 1 : d, None] * x[c + 1 :]) >> WORK).sum(axis=0)]
    return x


def _orthonormal(columns: np.ndarray) -> np.ndarray:
    """Gram-Schmidt, twice, in fixed-point integers."""
    from math import isqrt

    out: list[np.ndarray] = []
    for v in columns.T:
        for _ in range(2):
            # Sizes differ by hundreds of bits after a solve: normalise first.
            large = max(1, max(abs(x) for x in v))
            v = np.array([(x << WORK) // large for x in v], object)
            for u in out:
                v = v - ((u * (int((u * v).sum()) >> WORK)) >> WORK)
            norm = isqrt(int((v * v).sum()))
            v = np.array([(x << WORK) // max(1, norm) for x in v], object)
        out.append(v)
    return np.stack(out, axis=1)


def components(matrix: list[list[int]], roots: list[tuple[int, int, int]], count: int) -> list[tuple[float, list[float]]]:
    """(root as a share of the trace, unit eigenvector) for the first ``count``
    roots, largest first; of equal roots any orthonormal basis. The entry of
    largest size (the first of them) is positive."""
    d = len(matrix)
    trace = sum(matrix[i][i] for i in range(d))
    scaled = np.array([[(x << WORK) // trace for x in row] for row in matrix], object)
    out: list[tuple[float, list[float]]] = []
    for root, shift, multiplicity in roots:
        value = (root << WORK) // (trace << shift)
        shifted = scaled.copy()
        shifted[np.arange(d), np.arange(d)] -= value
        rng = np.random.default_rng(7)  # any start outside the null space's complement
        y = np.array([[int(v) for v in row] for row in rng.integers(-(1 << 40), 1 << 40, (d, multiplicity))], object) << (WORK - 40)
        for _ in range(3):
            y = _orthonormal(_solve(shifted, y))
        for v in y.T:
            at = max(range(d), key=lambda i: (abs(v[i]), -i))
            sign = 1 if v[at] >= 0 else -1
            out.append((value / (1 << WORK), [sign * int(x) / (1 << WORK) for x in v]))
    return out[:count]
