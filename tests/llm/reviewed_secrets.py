"""Reviewed findings: texts with one candidate of interest each, and whether it is a secret.

Made from a fixed seed. The hard negatives look as random as secrets do: identifiers of
objects, hashes of commits and files, embedded pictures, paths, versions of lock files.
"""

import random
import string
import uuid

HEX, B64, ALNUM = "0123456789abcdef", string.ascii_letters + string.digits + "+/", string.ascii_letters + string.digits


def _draw(rng, letters, n):
    return "".join(rng.choice(letters) for _ in range(n))


def reviewed(seed: int, n: int) -> list[tuple[str, str, str, float]]:
    """(text, candidate, source, label) for ``n`` findings of every form."""
    rng, out = random.Random(seed), []
    for i in range(n):
        word = rng.choice(["settings", "deploy", "client", "service", "cache"])
        h40, h64, b = _draw(rng, HEX, 40), _draw(rng, HEX, 64), _draw(rng, B64, 40)
        u, path = str(uuid.UUID(int=rng.getrandbits(128))), f"/srv/{word}/releases/v{rng.randint(1, 99)}/current"
        name = rng.choice(["api_token", "aws_secret_access_key", "SERVICE_AUTH_TOKEN", "db_password", "client_secret"])
        key = _draw(rng, ALNUM, rng.randint(24, 44))
        found = [
            (f"export {name}={key}\n", key, "code", 1.0),
            (f'{name} = "{b}"', b, "code", 1.0),
            (f"{word}: {{{name}: '{h40}'}}", h40, "code", 1.0),
            (f"request id {u} was handled by the {word}", u, "logs", 0.0),
            (f"merged in commit {h40} of the {word} branch", h40, "logs", 0.0),
            (f"sha256:{h64} {word}.tar.gz", h64, "lock", 0.0),
            (f'<img src="data:image/png;base64,{b}"/>', b, "web", 0.0),
            (f"see {path} for the {word}", path, "docs", 0.0),
            (f'integrity = "{_draw(rng, B64, 43)}="', None, "lock", 0.0),
            (f"def test_{word}_is_rebuilt_after_restart(): pass", f"test_{word}_is_rebuilt_after_restart", "tests", 0.0),
        ]
        out += [(t, c or t.split('"')[1], s, y) for t, c, s, y in found]
    return out
