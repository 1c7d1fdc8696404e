"""panelforge.plans."""
