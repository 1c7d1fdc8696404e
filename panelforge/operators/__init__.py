"""panelforge.operators."""
