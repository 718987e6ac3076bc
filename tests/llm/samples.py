"""Small inputs shared by the tests."""

import random

SF = "/root/testdata/sf0.001"
WORDS = [a + b for a in ("ka", "lo", "mi", "nu", "pe", "ri", "so", "tu") for b in ("n", "r", "st", "l", "m", "x")]


def sentence(seed: int, n: int) -> str:
    draw = random.Random(seed)
    return " ".join(draw.choice(WORDS) + str(draw.randrange(3)) for _ in range(n))
