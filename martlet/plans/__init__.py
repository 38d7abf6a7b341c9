"""Jobs and queries; each takes a Mart and returns a lazy DataFrame."""
