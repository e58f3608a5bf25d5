"""Jobs that chain operators: discover, crawl, download, resume."""
