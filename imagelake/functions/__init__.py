"""Column functions and small building blocks: picture arithmetic, class scores, names,
distributed row numbers, exact quantiles and salted joins."""
