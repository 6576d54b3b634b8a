"""Texts that every operator must take."""

LONG = " ".join(f"w{i % 977} the" for i in range(30_000))
TEXTS = [
    (1, None),
    (2, ""),
    (3, " \n\t \r"),
    (4, "one"),
    (5, "alpha beta gamma delta"),
    (None, "a text without an id, " * 20),
    (6, "a text without an id, " * 20),
    (7, LONG),
    (8, LONG + " end"),
    (9, "tie tie tie tie tie tie tie tie tie tie tie tie tie tie tie tie"),
    (10, "mail a.b@c.example.org or +1 (743) 555-3824, card 4111 1111 1111 1111, ip 10.0.0.1"),
    (11, "token = \"f33e61083db5dbdf4bd2369d2f80176e57f7fda2\" under the MIT License"),
    (12, "日本語 🎉 é " * 40),
    (12, "日本語 🎉 é " * 40),
    (12, "another text of the same id"),
]
