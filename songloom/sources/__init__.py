"""Reading and writing: song files, pages, scraped rows, stored answers, the store, CSV."""
