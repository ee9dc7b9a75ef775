"""Fixed-width input files for the tests."""


def render(layout, rows):
    """Fixed-width lines for dicts of column → text (missing → blank)."""
    lines = []
    for r in rows:
        parts = []
        for c in layout.columns:
            v = "" if r.get(c.name) is None else str(r[c.name])
            parts.append(v[: c.width].ljust(c.width))
        lines.append("".join(parts))
    return lines


def write_latin1(path, lines):
    with open(path, "wb") as f:
        f.write(("\n".join(lines) + "\n").encode("latin-1"))
    return path
