"""Porter's suffix stripping (M. F. Porter, 1980), with the short-word and irregular-word
departures that the usual ROUGE scorer's stemmer makes."""

# Whole words with a given stem.
IRREGULAR = {
    "sky": "sky",
    "skies": "sky",
    "dying": "die",
    "lying": "lie",
    "tying": "tie",
    "news": "news",
    "innings": "inning",
    "inning": "inning",
    "outings": "outing",
    "outing": "outing",
    "cannings": "canning",
    "canning": "canning",
    "howe": "howe",
    "proceed": "proceed",
    "exceed": "exceed",
    "succeed": "succeed",
}

# Suffix rules of steps 2 and 3 (measure > 0) and of step 4 (measure > 1).
STEP_2 = {
    "ational": "ate",
    "tional": "tion",
    "enci": "ence",
    "anci": "ance",
    "izer": "ize",
    "bli": "ble",
    "entli": "ent",
    "eli": "e",
    "ousli": "ous",
    "ization": "ize",
    "ation": "ate",
    "ator": "ate",
    "alism": "al",
    "iveness": "ive",
    "fulness": "ful",
    "ousness": "ous",
    "aliti": "al",
    "iviti": "ive",
    "biliti": "ble",
    "fulli": "ful",
}
STEP_3 = {
    "icate": "ic",
    "ative": "",
    "alize": "al",
    "iciti": "ic",
    "ical": "ic",
    "ful": "",
    "ness": "",
}
STEP_4 = (
    "al ance ence er ic able ible ant ement ment ent ion ou ism ate iti ous ive ize"
).split()


def _shape(word: str) -> str:
    """One letter per character: c for a consonant, v for a vowel."""
    marks = ""
    for i, ch in enumerate(word):
        vowel = ch in "aeiou" or (ch == "y" and i > 0 and marks[-1] == "c")
        marks += "v" if vowel else "c"
    return marks


def _measure(stem: str) -> int:
    return _shape(stem).count("vc")


def _has_vowel(stem: str) -> bool:
    return "v" in _shape(stem)


def _double_consonant(word: str) -> bool:
    return len(word) > 1 and word[-1] == word[-2] and _shape(word)[-1] == "c"


def _ends_cvc(word: str) -> bool:
    shape = _shape(word)
    if len(word) == 2:
        return shape == "vc"
    return shape[-3:] == "cvc" and word[-1] not in "wxy"


def _longest(word: str, suffixes) -> str:
    return max((s for s in suffixes if word.endswith(s)), key=len, default="")


def _cut(word: str, suffix: str) -> str:
    return word[: len(word) - len(suffix)]


def _plural(word: str) -> str:
    if word.endswith("ies") and len(word) == 4:
        return word[:-1]
    if word.endswith(("sses", "ies")):
        return word[:-2]
    if word.endswith("s") and not word.endswith("ss"):
        return word[:-1]
    return word


def _past(word: str) -> str:
    if word.endswith("ied"):
        return word[:-1] if len(word) == 4 else word[:-2]
    if word.endswith("eed"):
        return word[:-1] if _measure(word[:-3]) > 0 else word
    suffix = _longest(word, ("ed", "ing"))
    stem = _cut(word, suffix)
    if not suffix or not _has_vowel(stem):
        return word
    if stem.endswith(("at", "bl", "iz")):
        return stem + "e"
    if _double_consonant(stem):
        return stem if stem[-1] in "lsz" else stem[:-1]
    if _measure(stem) == 1 and _ends_cvc(stem):
        return stem + "e"
    return stem


def _final_y(word: str) -> str:
    if word.endswith("y") and len(word) > 2 and _shape(word[:-1])[-1] == "c":
        return word[:-1] + "i"
    return word


def _double_suffix(word: str) -> str:
    if word.endswith("alli") and _measure(word[:-4]) > 0:
        return _double_suffix(word[:-2])
    if word.endswith("logi"):
        return word[:-1] if _measure(word[:-3]) > 0 else word
    return _swap(word, STEP_2)


def _swap(word: str, rules: dict[str, str]) -> str:
    suffix = _longest(word, rules)
    if suffix and _measure(_cut(word, suffix)) > 0:
        return _cut(word, suffix) + rules[suffix]
    return word


def _bare_suffix(word: str) -> str:
    suffix = _longest(word, STEP_4)
    stem = _cut(word, suffix)
    if suffix and _measure(stem) > 1 and (suffix != "ion" or stem[-1] in "st"):
        return stem
    return word


def _final_e(word: str) -> str:
    if word.endswith("e"):
        stem = word[:-1]
        m = _measure(stem)
        if m > 1 or (m == 1 and not _ends_cvc(stem)):
            word = stem
    if word.endswith("ll") and _measure(word[:-1]) > 1:
        word = word[:-1]
    return word


def stem_word(word: str) -> str:
    """Stem one lower-case word; words of up to three letters stay as they are."""
    if len(word) <= 3:
        return word
    if word in IRREGULAR:
        return IRREGULAR[word]
    for step in (_plural, _past, _final_y, _double_suffix):
        word = step(word)
    for step in (lambda w: _swap(w, STEP_3), _bare_suffix, _final_e):
        word = step(word)
    return word
