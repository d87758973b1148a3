import re

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def sentence(rng, n, pool=None):
    pool = pool or ["alpha", "beta", "gamma", "délta", "eps", "zeta", "eta", "thetá", "iota", "kappa", "lambda", "mu"]
    return " ".join(rng.choice(pool) + (str(rng.randrange(40)) if rng.random() < 0.7 else "") for _ in range(n))
