"""Exact integer matrix products in a residue number system.

Components are taken modulo several small primes; each residue product is a
float32 matrix product whose sums stay below 2^24, hence exact. The signed
scores are rebuilt by Chinese remaindering in mixed radix. As many primes are
used as the bound on the scores asks for.
"""

from __future__ import annotations

import math

import numpy as np

LARGEST_PRIME = 1024
EXACT = 1 << 24  # whole numbers up to it are exact in float32


def primes_below(limit: int) -> list[int]:
    """Primes below the limit, the largest first."""
    return [n for n in range(limit - 1, 1, -1) if all(n % d for d in range(2, math.isqrt(n) + 1))]


PRIMES = primes_below(LARGEST_PRIME)
CHUNK = EXACT // (PRIMES[0] // 2) ** 2  # components whose products add up to less than 2^24


def enough_primes(bits: float) -> list[int]:
    """The primes whose product holds every signed score of up to ``bits`` bits."""
    product, used = 1, []
    for prime in PRIMES:
        if math.log2(product) > bits + 1.01:
            break
        used.append(prime)
        product *= prime
    if math.log2(product) <= bits + 1.01:
        raise OverflowError(f"no primes for scores of {bits:.0f} bits")
    return used


def symmetric(x: np.ndarray, prime: int) -> np.ndarray:
    """Residues from ``-(prime // 2)`` to ``prime // 2`` as float32."""
    rest = np.mod(x, x.dtype.type(prime)).astype(np.float32)
    rest[rest > prime // 2] -= prime
    return rest


def residue_product(a: np.ndarray, b: np.ndarray, prime: int) -> np.ndarray:
    """``a @ b.T`` modulo a prime, from 0 on, by float32 products over bounded chunks of components."""
    x, y = symmetric(a, prime), symmetric(b, prime)
    total = np.zeros((len(a), len(b)), np.int32)
    for start in range(0, a.shape[1], CHUNK):
        part = x[:, start : start + CHUNK] @ y[:, start : start + CHUNK].T
        total = np.mod(total + part.astype(np.int32), np.int32(prime))
    return total


def exact_scores(a: np.ndarray, b: np.ndarray, bits: float) -> np.ndarray:
    """``a @ b.T`` of whole numbers, exact; held to the range of a long but for its last value.

    ``bits`` is an upper bound of the scores' binary logarithm.
    """
    primes = enough_primes(bits)
    kind = np.int64 if math.prod(primes) < 2**62 else object
    total = np.zeros((len(a), len(b)), kind)
    radix = 1
    for prime in primes:
        digit = residue_product(a, b, prime).astype(np.int64)
        known = (total % prime).astype(np.int64)
        digit = (digit - known) * pow(radix, -1, prime) % prime
        total = total + digit.astype(kind) * radix
        radix *= prime
    total = np.where(total > radix // 2, total - radix, total)
    if kind is object:
        most = 2**63 - 1
        total = np.minimum(np.maximum(total, -most), most).astype(np.int64)
    return total


def score_bits(a: float, b: float) -> float:
    """Bits that hold the inner product of vectors of the given lengths, by Cauchy-Schwarz."""
    return math.log2(max(a, 1.0)) + math.log2(max(b, 1.0)) + 1e-6
