import random

import pytest

@pytest.fixture(scope="session")
def corpus():
    """Copies, near copies, shared passages, repetition, long and empty texts."""
    r = random.Random(5)
    vocabulary = ["".join(r.choice("abcdeéß") for _ in range(r.randint(1, 7))) for _ in range(400)]
    prose = lambda n: " ".join(r.choice(vocabulary) for _ in range(n))
    passage, line = prose(60), prose(9)
    rows = []
    for i in range(60):
        t = prose(r.randint(5, 160))
        if i % 7 == 0:
            t = t + " " + passage + "\n" + prose(20)
        if i % 4 == 0:
            t = line + "\n" + t
        if i % 5 == 0:
            t = t + f"\nPage {i} of 99 was printed by machine"
        rows.append((i, t))
    for i in range(60, 75):
        w = rows[0][1].split(" ")
        w[r.randrange(len(w))] = "changed"
        rows.append((i, " ".join(w)))
    rows += [(i, rows[14][1]) for i in range(75, 82)]
    rows += [(82, "und " * 300), (83, "und " * 200 + "x"), (84, "a" * 400), (85, "a" * 300 + "b" * 300)]
    rows += [(86, None), (87, ""), (88, " \t\n "), (89, "one two"), (90, "ONE two"), (91, prose(6000)), (92, "\n\n")]
    rows += [(-5, rows[20][1]), (10**15, rows[21][1] + " end")]
    r.shuffle(rows)
    return rows
