"""Column functions: dates, arrays, texts and scores."""
