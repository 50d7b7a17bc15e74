"""HTML pages to Markdown: a tolerant tree, transform passes, a renderer, and the one Arrow pass that applies them."""
