import math


def near(a, b):
    return math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-9)
