"""Made-up texts."""

import random

SYLLABLES = "an be co da el fi gu ho in ja ku lo mi no or pa qui re su ti ung vé wä xi yo zé".split()


def prose(seed, n):
    """n made-up words, some with capitals and stops, a line break now and then."""
    draw = random.Random(seed)
    out = []
    for i in range(n):
        word = "".join(draw.choice(SYLLABLES) for _ in range(draw.randint(1, 4)))
        word = word.capitalize() if draw.random() < 0.1 else word
        out.append(word + (draw.choice(".,") if draw.random() < 0.1 else "") + ("\n" if draw.random() < 0.05 else " "))
    return "".join(out).strip()


def changed(text, seed, share):
    draw = random.Random(seed)
    return " ".join("new" + str(draw.random())[2:8] if draw.random() < share else w for w in text.split(" "))
