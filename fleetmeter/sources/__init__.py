"""File sources, load bookkeeping and stored tables."""
