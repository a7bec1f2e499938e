import random

import pytest


def words(rng, n, size=2000):
    return " ".join(f"w{rng.randrange(size)}" for _ in range(n))


@pytest.fixture(scope="session")
def rng():
    return random.Random(5)
