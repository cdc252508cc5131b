"""No pair of streets that the exact check allows is lost to the cosine, however many streets there are."""

import random

from siteweave.llm import addresses as A


def slip(rng, s):
    i, c = rng.randrange(len(s)), rng.choice("abcdef")
    return rng.choice((s[:i] + s[i + 1 :], s[:i] + c + s[i:], s[:i] + c + s[i + 1 :], s[:i] + s[i + 1 : i + 2] + s[i : i + 1] + s[i + 2 :]))


def test_allowed_pairs_reach_the_cosine_at_any_size():
    rng = random.Random(3)
    pairs = [("fonpbusme", "fopnbusem"), ("acbdfeg", "abcdefg"), ("abc", "acb")]
    for _ in range(3000):
        a = "".join(rng.choice("abcdef"[: rng.randint(2, 6)]) for _ in range(rng.randint(3, 10)))
        b = slip(rng, a)
        pairs.append((a, slip(rng, b) if len(a) > 7 and len(b) > 3 else b))
    for a, b in pairs:
        if min(len(a), len(b)) < 3 or not A.same_place(("1", "", a, "", "", "", ""), ("1", "", b, "", "", "", "")):
            continue
        ga, gb = set(A.grams(a)), set(A.grams(b))
        for most in (10, 10**3, 10**9):
            rarity = {g: A.gram_weight(most if g in ga & gb else 1, most) for g in ga | gb}
            streets = A.Streets(rarity)
            assert streets.cosine(a, b) >= A.MIN_COSINE, (a, b)
            assert set(streets.prefix(a)) & set(streets.prefix(b)), (a, b)
