"""DataFrame operators the cleaners, views and reports are composed from."""
