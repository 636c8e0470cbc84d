"""Rows that every operator must stand."""

#: null, empty, blank, a tie, a repeated row and a null id
ODD_ROWS = [(1, None), (2, ""), (3, " \t\n"), (4, "a b c"), (5, "a b c"), (5, "a b c"), (None, "d e f g")]
