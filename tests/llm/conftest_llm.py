"""Plain Python versions of the word patterns."""

import re

ASCII = {i: i + 32 for i in range(65, 91)}


def words_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(ASCII))
