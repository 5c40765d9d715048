"""Plan building blocks: one-row statistics, exact order statistics, running totals."""
