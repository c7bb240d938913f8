"""Names that the tests of the subpackage share."""

import brute

SF_DIR = "/root/testdata/sf0.001"


def near(a, b, percent):
    both = len(a & b)
    return 100 * both >= percent * (len(a) + len(b) - both)


__all__ = ["SF_DIR", "brute", "near"]
