"""Parsing of ``Channel - Category - rest`` names."""


def _before_dash(text: str) -> str:
    return f"trim(substring({text}, 1, instr({text}, '-') - 1))"


def name_segment(name: str, position: int) -> str:
    """First or second dash-separated segment, trimmed.

    A segment exists only if a dash closes it: ``A-B`` has first segment ``A`` and an
    empty second one, ``NoDash`` has two empty ones. NULL stays NULL.
    """
    if position == 1:
        return _before_dash(name)
    if position == 2:
        return _before_dash(f"substring({name}, instr({name}, '-') + 1)")
    raise ValueError("position is 1 or 2")
