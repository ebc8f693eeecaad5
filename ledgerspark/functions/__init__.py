"""Column functions: text cleaning, typing, flags, calendar, labels, exact rounding."""
