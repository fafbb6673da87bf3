"""Generic DataFrame operators; column names are arguments."""
