"""Plain functions that mirror column expressions, for hooks outside the data plane."""


def flip(text: str) -> str | None:
    """The first == as !=, or None."""
    at = text.find("==")
    return None if at < 0 else text[:at] + "!=" + text[at + 2 :]
