"""Small documents with every awkward case, and plain-Python versions of the shared rules."""

import random
import re

WS = " \t\n\x0b\x0c\r"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def words(text):
    return re.findall("[^\x20\x09-\x0d]+", text or "")


def ascii_lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def awkward_docs(seed=7):
    """Nulls, empties, repeated rows, copies, near copies, shared lines and one very long text."""
    rnd = random.Random(seed)
    vocab = ["the", "and", "of", "Haus", "schön", "été", "niño", "über"] + [f"w{i}" for i in range(300)]

    def text(n, lines=4):
        return "\n".join(" ".join(rnd.choice(vocab) for _ in range(n)) for _ in range(lines))

    shared = "This line is shared by many of the documents, word for word."
    rows, bodies = [], [text(rnd.randint(5, 40)) for _ in range(30)]
    for i, body in enumerate(bodies):
        line = "  " + shared.upper() + "\t" if i % 3 == 0 else shared
        rows.append((i, body + ("\n" + line if i % 2 == 0 else ""), ["en", "de", None, "fr"][i % 4],
                     [None, "a", "b", "é", "a.b"][i % 5], 1))
    for i in range(6):                                  # exact copies of one text, one source
        rows.append((100 + i, bodies[0], "en", "hot", 1))
    base = text(60, 3).split(" ")
    for i in range(8):                                  # near copies: one word changed
        copy = list(base)
        copy[10 + 15 * i] = f"changed{i}"
        rows.append((200 + i, " ".join(copy), "en", "hot", 1))
    rows += [(300, None, None, None, None), (301, "", "en", "a", 0), (302, " \t\n ", "en", "a", 4),
             (303, "Word", "en", "a", 4), (304, "two words", "en", "a", 9), (305, "Word", "en", "b", 4)]
    rows += [rows[1], rows[1]]                          # repeated rows
    rows.append((400, text(3000, 10), "en", "hot", 1))  # a very long one
    return rows


def by_id(rows):
    return sorted(rows, key=lambda r: tuple((x is None, str(type(x)), x) for x in r))
