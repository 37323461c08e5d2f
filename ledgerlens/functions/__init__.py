"""Column-expression builders (no actions, no joins): calendar, interactions, math."""
