"""Made-up prose for the fixtures."""

WORDS = "alder birch cedar dune ember fjord grove heath islet jetty knoll larch marsh nook oasis pond quay ridge shoal tarn".split()


def prose(rng, n):
    return " ".join(rng.choice(WORDS) + rng.choice(["", "s", "en", "ly", "er"]) for _ in range(n))
