"""Fixture rows and helpers of the tests of the training-data operators."""


def edge_rows() -> list[tuple]:
    line = "A line that is long enough to count as a key of forty"
    passage = " ".join(f"word{k}" for k in range(60))
    texts = [None, "", "x", "\n", "   \n\t\n", f"{line}\nown {1}", f"  {line.upper()}\t\nown {2}", f"{line}\n{line}\nown 3", line, f"{line}\r\nlast",
             f"top {passage} end of the first", f"other start {passage} and another end", f"top {passage} end of the first",
             f"top {passage} end of the second", "ééé ñ 漢字 \U0001F600 " * 30, "na\x1cb\x85c d  don't 123 !!! <|endoftext|>",
             "mail a.b@c.example.com, ip 10.0.0.255 or 10.0.0.256 or 1.2.3.4.5; card 4111 1111 1111 1111 and 4111111111111112",
             "call +1 (988) 555-2485 or phone (988) 555-2485; iban DE89 3704 0044 0532 0130 00; ssn 123-45-6789; x@y.z_w@v.u",
             "ab " * 4000, "z" * 70000, " ".join(str(k) for k in range(15000)), "SHOUT!! " * 80]
    rows = [(k, t, "s", "n", "k", "v") for k, t in enumerate(texts)]
    return rows + [rows[5], rows[12], (None, line, None, None, None, None), (None, "no id", None, None, None, None), (7, "same id, other text", "", "", "", "")]


def collect(df) -> list[tuple]:
    return [tuple(r) for r in df.collect()]
