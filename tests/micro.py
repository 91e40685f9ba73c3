"""A small corpus that holds every rule's edge."""

NBSP = chr(0xA0)

ROWS = [
    ("a", "The hero's journey, the HERO returns!"),
    ("b", "hero  alien  alien"),
    ("c", "the of and"),
    ("d", "!!!"),
    ("e", None),
    ("f", "alien world"),
    ("f", "world hero"),
    ("g", f"space{NBSP}travel alien"),
    ("h", "hero  alien  alien"),
    ("i", "   "),
    ("j", ""),
    ("k", "  lead\tworld \n"),
    ("l", "high-stakes world"),
]

QUERIES = [
    (1, "Alien"),
    (2, "unicorn"),
    (3, "hero world"),
    (4, "hero unicorn"),
    (5, "unicorn dragon"),
    (6, "the of and"),
    (7, "alien alien"),
    (8, "!!!"),
    (9, f"space{NBSP}travel"),
    (10, "A young hero's journey to save the world"),
    (11, "high-stakes"),
    (12, ""),
    (13, "  lead   world "),
]
