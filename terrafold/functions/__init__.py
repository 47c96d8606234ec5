"""Part of terrafold."""
