"""Column expressions: text, urls, dates, html and rendering."""
