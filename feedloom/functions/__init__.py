"""Column expressions: text, dates, URLs and the HTML walk."""
