"""Explicit schemas of the records that stages exchange; nothing is inferred."""

ARTICLE = (
    "title string, year string, url string, url_filename string, pdf string, hash string, has_text boolean, types array<string>, subjects array<string>, authors string, date_scraped string, "
    "page_title string, source_page string, disposition_title string, link_title string, page_headings array<string>, path string, did string"
)
MANIFEST = f"metadata struct<organisation:string,`start-time`:string,`stop-time`:string>, content map<string,array<string>>, data map<string,struct<{', '.join(f.strip().replace(' ', ':', 1) for f in ARTICLE.split(', '))}>>"
PDF_LINE = "size int, bold boolean, text string, page_number int, font_face string"
PARSED_PDF = f"file_hash string, sections map<string,array<string>>, keywords map<string,array<string>>, text string, pdf_metadata struct<created:string,creator:string,file_size:string,page_rot:string,title:string,author:string>, source_metadata struct<{', '.join(f.strip().replace(' ', ':', 1) for f in ARTICLE.split(', '))}>, title_candidates array<string>, errors array<string>"
SPLIT_REFS = "doc_id string, doc_url string, references array<string>"
STRUCTURED_REF = "Authors string, Journal string, Volume string, Issue string, Pagination string, Title string, PubYear string, document_id string, document_url string, reference_id long"
PUBLICATION = "uber_id long, pmid string, pmcid string, doi string, title string, authors array<struct<LastName:string,Initials:string>>, journalTitle string, issue string, journalVolume string, pubYear int, journalISSN string, pubType string"
COMPONENTS = ("Authors", "Journal", "Volume", "Issue", "Pagination", "Title", "PubYear")
