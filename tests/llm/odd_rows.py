"""Documents with every odd case: nulls, empty and very long texts, ties,
repeated rows and extra columns with names that operators use inside."""
import random

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, id long, "
          "n string, token long, part string, size int, start int, row string")
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi".split()


def sentence(rng, n):
    return " ".join(rng.choice(WORDS) + str(rng.randint(0, 40)) for _ in range(n))


def odd_documents():
    rng = random.Random(5)
    base = [sentence(rng, 120) for _ in range(6)]
    shared = sentence(rng, 30)
    texts = [
        base[0], base[0], base[0] + " tail", base[1], base[1].replace("alpha", "omega", 1),
        base[2] + "\n" + shared, shared + "\n" + base[3], None, "", "   \n\t ", "one two",
        "One TWO", "Ünïcode é文字 " + shared, "x" * 60, "x" * 120, "ab " * 100_000, base[4],
        base[4], "!!! 123", sentence(rng, 4), base[5].upper(), base[5]]
    rows = [(i, t, "en" if i % 3 else "de", f"s{i % 4}", len(t or "")) for i, t in enumerate(texts)]
    rows += [rows[3], (100, base[0], None, None, None), (None, base[2], "en", "s0", None),
             (None, None, None, None, None), (7, "second text of one id " + base[1], "en", "s1", 0)]
    return [(*r, 1, "n", 2, "p", 3, 4, "r") for r in rows]
